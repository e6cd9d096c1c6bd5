"""Suffix trees (Ukkonen 1995) and constant-time longest common extensions. Used inside tasks.

A tree of n symbols has at most 2n nodes. Its Euler tour holds the string depth of every node visited; the longest
common extension of two suffixes is the depth of their lowest common ancestor, which is the least depth on the
tour between their leaves. That minimum comes from tables: minima of blocks of the tour over powers of two, minima from
each block's two ends, and short powers of two for two places in one block.
"""

from __future__ import annotations

import numpy as np

BLOCK = 16
# The end of a sequence: less than every symbol, and different from all of them.
END = -1


class _Minima:
    """Least value between any two places of an array, for arrays of places at once."""

    def __init__(self, values: np.ndarray) -> None:
        n = -(-len(values) // BLOCK) * BLOCK
        padded = np.full(n, np.iinfo(values.dtype).max, values.dtype)
        padded[: len(values)] = values
        rows = padded.reshape(-1, BLOCK)
        self.ahead = np.minimum.accumulate(rows, axis=1).ravel()
        self.behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.short, self.wide = self._doubled(padded, BLOCK), self._doubled(rows.min(axis=1), n)

    @staticmethod
    def _doubled(values: np.ndarray, most: int) -> list[np.ndarray]:
        out, width = [values], 1
        while width * 2 <= min(most, len(values)):
            last = out[-1].copy()
            np.minimum(last[:-width], out[-1][width:], out=last[:-width])
            out.append(last)
            width *= 2
        return out

    @staticmethod
    def _between(tables: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), tables[0].dtype)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(tables[k][first[at]], tables[k][last[at] - (1 << k) + 1])
        return out

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least of the places first..last, both included."""
        a, b = first // BLOCK, last // BLOCK
        out = np.minimum(self.behind[first], self.ahead[last])
        inside, over = np.flatnonzero(a == b), np.flatnonzero(b - a > 1)
        if len(inside):
            out[inside] = self._between(self.short, first[inside], last[inside])
        if len(over):
            out[over] = np.minimum(out[over], self._between(self.wide, a[over] + 1, b[over] - 1))
        return out


class SuffixTree:
    """The suffixes of ``symbols`` (whole numbers from 0) followed by an end that is less than all of them."""

    def __init__(self, symbols: list[int]) -> None:
        text = [*symbols, END]
        tour, self.first, self.order = _euler_tour(*_grown(text), len(text))
        self.minima = _Minima(tour)

    def ranks(self) -> np.ndarray:
        """Place of every suffix, that of the end included, in the order of all suffixes."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.arange(len(self.order))
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes ``i`` and ``j``, which differ."""
        a, b = self.first[i], self.first[j]
        return self.minima.of(np.minimum(a, b), np.maximum(a, b)).astype(np.int64)


def _grown(text: list[int]) -> tuple[list[int], list[int], list[dict[int, int] | None]]:
    """Ukkonen's tree: first and end place of every node's edge, and its children by first symbol (None: a leaf).

    Leaves come in the order of their suffixes. The last symbol stands nowhere else, so every suffix has a leaf.
    """
    n = len(text)
    start, end, kids, link = [0], [0], [{}], [0]
    node = place = length = waiting = 0
    for i, symbol in enumerate(text):
        unlinked = 0
        waiting += 1
        while waiting:
            if not length:
                place = i
            lead = text[place]
            child = kids[node].get(lead)
            if child is None:
                kids[node][lead] = len(start)
                start.append(i), end.append(n), kids.append(None), link.append(0)
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                at = start[child]
                size = end[child] - at
                if length >= size:
                    # walk down
                    place += size
                    length -= size
                    node = child
                    continue
                if text[at + length] == symbol:
                    length += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                inner = len(start)
                kids[node][lead] = inner
                start.append(at), end.append(at + length), link.append(0)
                kids.append({text[at + length]: child, symbol: inner + 1})
                start[child] = at + length
                start.append(i), end.append(n), kids.append(None), link.append(0)
                if unlinked:
                    link[unlinked] = inner
                unlinked = inner
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                place = i - waiting + 1
    return start, end, kids


def _euler_tour(start: list[int], end: list[int], kids: list[dict[int, int] | None], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String depths along the tour, the first visit of every suffix's leaf, and the suffixes in order."""
    depth = [0] * len(start)
    tour, visits, order = [], [0] * n, []
    todo = [0]
    while todo:
        node = todo.pop()
        if node < 0:
            tour.append(depth[~node])
            continue
        below = kids[node]
        if below is None:
            # a leaf's edge ends the text, so its depth tells its suffix
            suffix = n - depth[node]
            visits[suffix] = len(tour)
            order.append(suffix)
        else:
            here, again = depth[node], ~node
            for symbol in sorted(below, reverse=True):
                child = below[symbol]
                depth[child] = here + end[child] - start[child]
                todo += (again, child)
        tour.append(depth[node])
    return np.array(tour, np.int32), np.array(visits, np.int64), np.array(order, np.int64)
