"""Token ids of a byte-level BPE, from the ``tokenizers`` library and a table of what it gave before.

The pre-tokenizer never joins what stands before white space that follows other characters with what
comes after, so a text is cut there into chunks (white space and the run after it) and ids of a text
are the ids of its chunks in order. Marks after a letter or digit are a token of their own there, and so
is a single newline before a word, so chunks are cut there as well. A text that holds the name of an added
token goes through the library whole, unless such names are taken as ordinary text (``plain_names``).

Texts are cut as bytes, a batch at a time: places to cut are found with array operations, the pieces share the
batch's own buffer, and only its different pieces are looked up and have Python objects. Each different piece is
encoded by the library once and kept; a full table becomes the old one, from which what is still in use is taken
over, and the one before it goes. A piece of Latin letters alone is one piece of the pre-tokenizer, so it goes
straight to the library's model, in the bytes' own letters. The ids of a batch are gathered from those of its
different pieces.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .frames import held

# Pieces kept per table; two tables at most. Workers keep them between tasks, about 200 bytes each.
MAX_KEPT = 300_000
# Bytes of text cut together (one text at least); a few times as much is held meanwhile.
GROUP_BYTES = 4 << 20
# Parts sent to the library as one text, with a newline between them.
JOINED = 64
MARKS = ".,;:!?*$%&#|<>-"

# Pieces of Latin letters alone, without or with a leading space; every one is a letter to the library too.
_letters = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch
# White space other than a leading space. The library's does not count \x1c to \x1f, which may stand in either class here.
_inner_space = re.compile(r".\s", re.DOTALL).search
# White space of three bytes, as numbers.
_WIDE_SPACES = np.array([int.from_bytes(chr(c).encode(), "big") for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)])


def _table(chars: str) -> np.ndarray:
    """Which bytes stand for one of these ASCII characters."""
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_IS_MARK = _table(MARKS)
_IS_ALNUM = _table("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _byte_letters() -> str:
    """The letter that stands for each byte in the vocabulary; the newline stays, to cut at."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(b for b in range(0x100) if b not in shown)}
    return "".join("\n" if b == 0x0A else letters[b] for b in range(0x100))


def _spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space."""
    space = (data == 0x20) | (data - np.uint8(9) < 5)
    two = np.flatnonzero(data[:-1] == 0xC2)
    two = two[(data[two + 1] == 0x85) | (data[two + 1] == 0xA0)]
    three = np.flatnonzero(data[:-2] - np.uint8(0xE1) < 3)
    if len(three):
        three = three[np.isin((data[three].astype(np.int32) << 16) | (data[three + 1].astype(np.int32) << 8) | data[three + 2], _WIDE_SPACES)]
    for first, width in ((two, 2), (three, 3)):
        for k in range(width):
            space[first + k] = True
    return space


def _after_alnum(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Those of the places ``at`` that follow an ASCII letter or digit or a Latin letter of two bytes."""
    last = data[at - 1]
    before = data[at - 2]
    latin = ((before > 0xC3) & (before < 0xC9)) | ((before == 0xC3) & (last != 0x97) & (last != 0xB7)) | ((before == 0xC9) & (last < 0x90))
    return at[_IS_ALNUM[last] | ((last > 0x7F) & (last < 0xC0) & latin)]


def cut_places(data: np.ndarray, edges: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Places where pieces begin in the bytes of texts that lie between ``edges``; ``whole``: texts that stay in one piece."""
    if not len(data):
        return np.empty(0, np.int64)
    space = _spaces(data)
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    firsts = edges[:-1][edges[1:] > edges[:-1]]
    begins[firsts] = True
    # one newline alone is a token; of several the library may join some
    lone = begins[:-1] & (data[:-1] == 0x0A)
    lone &= ~space[1:]
    begins[1:] |= lone
    begins[_after_alnum(data, np.flatnonzero(_IS_MARK[data[1:]]) + 1)] = True
    for k in whole.tolist():
        begins[edges[k] + 1 : edges[k + 1]] = False
    return np.flatnonzero(begins)


class Encoder:
    """Ids of texts as unsigned 32-bit numbers."""

    def __init__(self, path: str, plain_names: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        # special tokens only; other added tokens keep their ids in the library
        self.tokenizer.encode_special_tokens = plain_names
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.names = [t.content for t in added if t.content and not (plain_names and t.special)]
        self.newline = self._ids("\n")
        self.model, self.byte_letters = self.tokenizer.model, _byte_letters()
        split = self.tokenizer.pre_tokenizer
        # words go to the model only where nothing but the usual split stands before it
        self.direct = self.tokenizer.normalizer is None and isinstance(split, ByteLevel) and split.use_regex and not split.add_prefix_space
        self.kept: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _ask(self, parts: list[str]) -> None:
        """Ids of parts without white space but one leading space."""
        kept = self.kept
        for at in range(0, len(parts), JOINED):
            some = parts[at : at + JOINED]
            ids = self._ids("\n".join(some))
            cuts = np.flatnonzero(ids == self.newline[0]) * 4
            raw, first = ids.tobytes(), 0
            for part, cut in zip(some, [*cuts.tolist(), len(raw)], strict=True):
                kept[part] = raw[first:cut]
                first = cut + 4

    def _ask_words(self, words: list[str]) -> None:
        """Ids of pieces of letters alone."""
        tokenize, ids, ends = self.model.tokenize, [], []
        for text in "\n".join(words).encode().decode("latin-1").translate(self.byte_letters).split("\n"):
            ids += [token.id for token in tokenize(text)]
            ends.append(4 * len(ids))
        raw, first = np.array(ids, "<u4").tobytes(), 0
        for word, end in zip(words, ends, strict=True):
            self.kept[word] = raw[first:end]
            first = end

    def _learn(self, unknown: list[str]) -> None:
        """Ids of pieces that the table lacks."""
        kept, old = self.kept, self.old
        letters = _letters if self.direct else lambda piece: None
        words, asked = [], []
        for piece in unknown:
            if (ids := old.get(piece)) is not None:
                kept[piece] = ids
            elif letters(piece):
                words.append(piece)
            elif piece.isspace() or piece[0] != " " and piece[0].isspace() or _inner_space(piece):
                kept[piece] = self.newline.tobytes() if piece == "\n" else self._ids(piece).tobytes()
            else:
                asked.append(piece)
        if asked:
            self._ask(asked)
        if words:
            self._ask_words(words)

    def _named(self, raw: bytes, edges: np.ndarray) -> np.ndarray:
        """Texts that hold the name of an added token (or may, with the text next to them)."""
        found = set()
        for name in map(str.encode, self.names):
            at = raw.find(name)
            while at >= 0:
                found.add(int(np.searchsorted(edges, at, "right")) - 1)
                at = raw.find(name, at + 1)
        return np.array(sorted(found), np.int64)

    def _group(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        n = len(texts)
        edges = np.frombuffer(texts.buffers()[1], np.int32, n + 1, 4 * texts.offset).astype(np.int64)
        if edges[-1] == edges[0]:
            return np.empty(0, "<u4"), np.zeros(n + 1, np.int64)
        buffer = texts.buffers()[2].slice(int(edges[0]), int(edges[-1] - edges[0]))
        edges -= edges[0]
        whole = self._named(buffer.to_pybytes(), edges) if self.names else np.empty(0, np.int64)
        places = cut_places(np.frombuffer(buffer, np.uint8), edges, whole)
        pieces = pa.StringArray.from_buffers(len(places), pa.py_buffer(np.append(places, edges[-1]).astype(np.int32)), buffer).dictionary_encode()
        codes, different = pieces.indices.to_numpy(), pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        bounds = np.searchsorted(places, edges)
        named = set(codes[bounds[whole]].tolist())
        if len(self.kept) > MAX_KEPT:
            self.old, self.kept = self.kept, {}
        got = list(map(self.kept.get, different))
        for k in named:
            got[k] = self._ids(different[k]).tobytes()
        missing = [k for k, ids in enumerate(got) if ids is None]
        self._learn([different[k] for k in missing])
        for k in missing:
            got[k] = self.kept[different[k]]
        # ids of all pieces in order: each piece's place among those of the different ones
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // 4
        flat, first = np.frombuffer(b"".join(got), "<u4"), np.cumsum(sizes) - sizes
        widths = sizes[codes]
        ends = np.cumsum(widths)
        source = np.repeat(first[codes] - (ends - widths), widths)
        source += np.arange(len(source))
        return flat[source], np.append(0, ends)[bounds]

    def encode_arrays(self, texts: pa.Array, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For group after group of texts: the first one's number, all their ids with ``end_id`` after each text, and
        where each text's ids begin (one more than texts). Null is empty."""
        texts = texts.cast(pa.string())
        if texts.null_count:
            texts = texts.fill_null("")
        if not len(texts):
            return
        edges = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(edges, int(edges[at]) + GROUP_BYTES, "right")) - 1)
            ids, places = self._group(texts.slice(at, to - at))
            yield at, np.insert(ids, places[1:], end_id), places + np.arange(len(places))
            at = to

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian bytes, one bytes object per text."""
        out: list[bytes] = []
        for _, ids, edges in self.encode_arrays(pa.array(texts, pa.string()), 0):
            raw = ids.tobytes()
            out += [raw[4 * a : 4 * b - 4] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        return out


@lru_cache(maxsize=2)
def encoder(path: str, plain_names: bool = False) -> Encoder:
    """One encoder per worker process, kept over tasks until the process turns to other work."""
    held("encoder", encoder.cache_clear)
    return Encoder(path, plain_names)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
