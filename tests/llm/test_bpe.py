"""Ids from kept chunks equal the library's ids of the whole text."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, normalizers

from noctule.llm import bpe, language, packing, token_file, words

PARTS = ["a", "the", "Word", "é", "ß", "中", "\n", " ", "  ", "\t", "\u0085", "\r\n", "!", "...", "'s", "'", "123", "½", "\x1c", "𝔘", "<|endoftext|>", "-", "$$$", "́", "_", " b", "\n\n"]


def test_any_mixture_of_space_marks_and_letters(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_KEPT", 500)
    rng = random.Random(1)
    encoder, library = bpe.Encoder(bpe.default_path()), Tokenizer.from_file(bpe.default_path())
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(4000)] + ["", " ", "\n", "a\n", " a", "a ", "\n a"]
    texts += ["hello <|endoftext|> x", "<|endoftext|>", "a<|endoftext|><|endoftext|>\n", "<|endoftext|"] * 3
    whole = library.encode_batch(texts, add_special_tokens=False)
    assert encoder.encode(texts) == [np.array(x.ids, "<u4").tobytes() for x in whole]
    assert encoder.encode(["hello <|endoftext|> x"]) == [np.array([31373, 220, 50256, 2124], "<u4").tobytes()]
    library.encode_special_tokens = True
    whole = library.encode_batch(texts, add_special_tokens=False)
    assert bpe.Encoder(bpe.default_path(), plain_names=True).encode(texts) == [np.array(x.ids, "<u4").tobytes() for x in whole]


def test_words_between_single_spaces_and_newlines():
    rng = random.Random(3)
    words = ["a", "Word", "é,", "...", "it's", "123", "$$$", "中文", "x_y", "_", "-", "'s", "½!", "<|endoftext|"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", "\n", "\n\n", "\n "]) for _ in range(rng.randint(1, 20)))[: -rng.randint(1, 2)] for _ in range(2000)]
    texts += [before + t for before in (" ", "\n", "\n\n", "\n ") for t in texts[:200]]
    encoder, library = bpe.Encoder(bpe.default_path()), Tokenizer.from_file(bpe.default_path())
    assert encoder.encode(texts) == [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch(texts, add_special_tokens=False)]


def test_words_of_latin_letters_go_straight_to_the_model(monkeypatch):
    rng = random.Random(5)
    letters = [chr(c) for c in range(0x250) if bpe._letters(chr(c))]
    assert len(letters) == 2 * 26 + 62 + 0x150 and all(x.isalpha() for x in letters)
    some = [x + y for x in letters for y in ("", "e", "Ω", "ª")] + ["".join(rng.choices(letters[:60] + letters, k=rng.randint(1, 12))) for _ in range(3000)]
    rng.shuffle(some)
    texts = ["".join(w + rng.choice([" ", " ", "\n", ", ", "."]) for w in some[at : at + 40]) for at in range(0, len(some), 40)]
    encoder, library = bpe.Encoder(bpe.default_path()), Tokenizer.from_file(bpe.default_path())
    assert encoder.encode(texts) == [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch(texts, add_special_tokens=False)]
    plain, want = "Straße garçon Noël words\nof letters", library.encode("Straße garçon Noël words\nof letters", add_special_tokens=False).ids
    encoder = bpe.Encoder(bpe.default_path())
    monkeypatch.setattr(encoder, "_ids", lambda text: pytest.fail(f"{text!r} went through the pre-tokenizer"))
    assert encoder.encode([plain]) == [np.array(want, "<u4").tobytes()]


def test_a_batch_looks_up_each_different_piece_once():
    class Counted(dict):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

    encoder, library = bpe.Encoder(bpe.default_path()), Tokenizer.from_file(bpe.default_path())
    encoder.kept = Counted()
    texts = ["one two, three.\nfour " * 500] * 20
    assert encoder.encode(texts) == [np.array(library.encode(texts[0], add_special_tokens=False).ids, "<u4").tobytes()] * 20
    assert encoder.kept.asked < 20


def test_arrays_of_any_form_cut_at_any_place(monkeypatch):
    rng = random.Random(7)
    parts = [*PARTS, "\u00a0", "\u2003", "\u3000", "\u200b", "\u1680", "é,", "×,", "÷.", "ª;", "ɏ!", "ɐ!", "ȿ-", "it's.", "don't", ",'s", "a,b", "-'ll", "٣.", "\n\u00a0", "\n\n\n", "\v", "\f"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) if rng.random() < 0.95 else None for _ in range(4000)]
    texts += ["a <|endof", "text|> b", "", "<|endoftext|>", "\n", " a", "\n", "b"] * 3
    library = Tokenizer.from_file(bpe.default_path())
    want = [[*x.ids, 7] for x in library.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    for size in (1, 500, 1 << 20):
        monkeypatch.setattr(bpe, "GROUP_BYTES", size)
        for array, first in ((pa.array(texts), 0), (pa.array(texts, pa.large_string()), 0), (pa.array(texts).slice(1001, 900), 1001)):
            encoder, seen = bpe.Encoder(bpe.default_path()), 0
            for at, ids, edges in encoder.encode_arrays(array, 7):
                assert at == seen and edges[0] == 0 and edges[-1] == len(ids)
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    assert ids[a:b].tolist() == want[first + seen]
                    seen += 1
            assert seen == len(array)
    assert not list(encoder.encode_arrays(pa.array([], pa.string()), 7))
    ((at, ids, edges),) = encoder.encode_arrays(pa.array([None, "", None], pa.string()), 7)
    assert (at, ids.tolist(), edges.tolist()) == (0, [7, 7, 7], [0, 1, 2, 3])


def test_a_split_of_another_kind_keeps_its_own_words(tmp_path):
    other = Tokenizer.from_file(bpe.default_path())
    other.normalizer = normalizers.Lowercase()
    other.save(f"{tmp_path}/lower.json")
    encoder = bpe.Encoder(f"{tmp_path}/lower.json")
    assert encoder.encode(["Some Words"]) == [np.array(other.encode("Some Words", add_special_tokens=False).ids, "<u4").tobytes()]


def test_files_and_pieces_hold_the_library_s_ids(spark):
    texts = {1: "a <|endoftext|> b", 2: "<|endoftext|>", 3: "plain words", 4: ""}
    library = Tokenizer.from_file(bpe.default_path())
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for end, rows in ((0, token_file.roundtrip(docs, end_id=0)), (2, packing.pack_documents(docs, end_id=2))):
        got = {r["doc_id"]: r["ids_crc32"] for r in rows.collect()}
        assert got == {k: zlib.crc32(np.array([*library.encode(t, add_special_tokens=False).ids, end], "<u4").tobytes()) for k, t in texts.items()}


@pytest.mark.parametrize("work", [lambda b: words.blocks(b, "text"), language._groups])
def test_a_worker_that_turns_to_other_work_drops_its_table(work):
    ids = bpe.encoder(bpe.default_path()).encode(["some words", "more words"])
    assert bpe.encoder.cache_info().currsize
    assert list(work(pa.record_batch({"text": ["a b"]})))
    assert not bpe.encoder.cache_info().currsize
    assert bpe.encoder(bpe.default_path()).encode(["some words", "more words"]) == ids


def test_simple8b_round_trip():
    rng = np.random.default_rng(2)
    for values in (
        np.empty(0, np.uint64),
        np.zeros(5000, np.uint64),
        np.arange(7, dtype=np.uint64),
        rng.integers(0, 1 << 16, 12_345).astype(np.uint64),
        (np.uint64(1) << rng.integers(0, 64, 9000).astype(np.uint64)),
        (rng.zipf(1.3, 30_000) % 50_257).astype(np.uint64),
        np.array([(1 << 60) - 1, 1 << 60, (1 << 64) - 1, 0, 1], np.uint64),
    ):
        words, offsets, escaped = token_file.encode(values)
        out = token_file.decode(words, offsets, len(values))
        out[escaped] = values[escaped]
        assert (out == values).all() and offsets[-1] == len(words)
        # any block decodes without the ones before it
        if len(offsets) > 2:
            first, last = int(offsets[1]), int(offsets[2])
            alone = token_file.decode(words[first:last], np.array([0, last - first]), min(token_file.BLOCK, len(values) - token_file.BLOCK))
            assert (alone[:100] == np.where(values >= 1 << 60, 0, values)[token_file.BLOCK :][:100]).all()


@pytest.mark.parametrize("blocks", [1, 2, 128])
def test_stretches_of_blocks_decode_alike(monkeypatch, blocks):
    monkeypatch.setattr(token_file, "BLOCKS", blocks)
    rng = np.random.default_rng(3)
    for n in (0, 1, 2047, 2048, 2049, 4096, 9001):
        values = np.where(rng.random(n) < 0.5, 0, rng.integers(0, 1 << 17, n)).astype(np.uint64)
        words, offsets, _ = token_file.encode(values)
        assert (token_file.decode(words, offsets, n) == values).all()
