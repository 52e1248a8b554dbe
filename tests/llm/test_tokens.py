"""Tokenizers, packing and matrices against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from tokenizers import Tokenizer

from parcelmart.llm import jaccard_join, tokens
from parcelmart.llm.bpe import SpeculativeBpe, decode_ids, encode_texts, round_trip_digests
from parcelmart.llm.packing import pack, padded_length
from parcelmart.llm.token_matrix import CapacityTree, best_fit_decreasing, position_ids, token_matrix
from parcelmart.llm.tokens import ID_TYPE, WordTokenizer, public_path
from tests.llm.messy import TEXTS, empty, messy, texts_of

WORD, BYTE = public_path("word_bpe_49k.json"), public_path("byte_bpe_50k.json")


@lru_cache
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def library_ids(path: str, text: str | None) -> np.ndarray:
    return np.array(library(path).encode(text or "", add_special_tokens=False).ids, ID_TYPE)


def odd_texts() -> list[str | None]:
    rng = random.Random(3)
    letters = "abcdetthinger \n\t.,!?ñéß'0 9~^`@| ́"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 50))) for _ in range(1500)]
    return [t for _, t in TEXTS] + made + ["supercalifragilistic aaaaaaaaaaaaaa abababab antidisestablishmentarianism"]


@pytest.mark.parametrize(("kind", "path"), [(WordTokenizer, WORD), (WordTokenizer, BYTE), (SpeculativeBpe, BYTE)])
def test_ids_equal_the_library(kind, path):
    tokenizer = kind(path, cache_words=500)  # small, so that it is emptied on the way
    texts = odd_texts()
    for text, ids in zip(texts, tokenizer.encode_all(texts)):
        assert ids == library_ids(path, text).tobytes(), text


def test_words_of_letters_go_to_the_model_only(monkeypatch):
    asked: list[str] = []
    whole = WordTokenizer.encode_words
    tokenizer = WordTokenizer(WORD, narrow=True)
    monkeypatch.setattr(WordTokenizer, "encode_words", lambda self, words: asked.extend(words) or whole(self, words))
    rng = random.Random(5)
    letters = [c for c in map(chr, range(65, 256)) if c.isalpha()]
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(800)] + letters + ["Straße", "ÀÉÎ"]
    texts = [" ".join(words), None, " ".join(f"{w}," for w in words), "", "a1 can't 12:30 ñandú", "e\u0301t ª º µm"]
    for text, ids in zip(texts, tokenizer.encode_all(texts)):
        assert ids == library_ids(WORD, text).astype("<u2").tobytes(), text
    assert set(asked) & set(words) <= {"ª", "º", "µ"} | {w for w in words if set(w) & set("ªºµ")} and "can't" in asked


def test_words_held_per_worker_are_few():
    # Two workers an executor keep these until they end, beside a heap of 60 % of its memory.
    tokenizer = WordTokenizer(WORD, cache_words=100, narrow=True)
    for i in range(30):
        tokenizer.encode_all([f"w{i}x{k}" for k in range(50)])
        assert len(tokenizer.cache) <= 100 + 51 + len(tokenizer.fixed)
    assert tokens.CACHE_WORDS <= 800_000 and jaccard_join.CACHE_WORDS <= 100_000


def test_decoding_equals_the_library():
    bpe = SpeculativeBpe(BYTE)
    rng = np.random.default_rng(1)
    for size in (0, 1, 7, 900):
        ids = rng.integers(0, 50257, size).astype(ID_TYPE)
        assert bpe.decode(ids.tobytes()) == library(BYTE).decode(ids.tolist(), skip_special_tokens=False)


def test_round_trip(spark):
    docs = messy(spark)
    back = decode_ids(encode_texts(docs, BYTE), BYTE)
    assert Counter((r[0], r[1]) for r in back.collect()) == Counter((i, t or "") for i, t in texts_of(docs))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = Counter(
        (i, len(library_ids(BYTE, t)), sha(library_ids(BYTE, t).tobytes()), sha((t or "").encode())) for i, t in texts_of(docs)
    )
    assert Counter(map(tuple, round_trip_digests(docs, BYTE).collect())) == expected
    assert round_trip_digests(empty(spark), BYTE).count() == 0


@pytest.mark.parametrize("sequence", [16, 2048])
def test_packing(spark, sequence):
    docs = messy(spark)
    rows = pack(docs, WORD, sequence=sequence, with_ids=True).collect()
    whole = Counter()
    pieces: dict = {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        pieces.setdefault(r["sequence_id"], []).append(r)
    for number, held in pieces.items():
        held.sort(key=lambda r: r["offset"])
        at = 0
        for r in held:
            assert r["offset"] == at
            at += r["length"]
        assert at == held[0]["sequence_tokens"] == (sequence if number < max(pieces) else at)
        assert held[0]["padded_to"] == padded_length(at, sequence)
    assert sorted(pieces) == list(range(len(pieces)))
    # Read in order, the pieces give back every document, each with its end mark.
    ordered = [r for n in sorted(pieces) for r in pieces[n]]
    current = b""
    for r in ordered:
        assert r["start"] == len(current) // 4 and r["continued"] == (r["start"] > 0)
        current += bytes(r["ids"])
        assert r["continues"] == (len(current) // 4 < r["doc_tokens"])
        if not r["continues"]:
            whole[(r["doc_id"], current)] += 1
            current = b""
    end = np.array([1], ID_TYPE).tobytes()
    assert whole == Counter((i, library_ids(WORD, t).tobytes() + end) for i, t in texts_of(docs))


def test_packing_nothing(spark):
    assert pack(empty(spark), WORD).count() == 0
    assert pack(messy(spark).filter("text IS NULL"), WORD, end_id=None).count() == 0


def test_padded_length():
    assert [padded_length(n) for n in (1, 2, 3, 512, 1000, 2048)] == [1, 2, 2048, 512, 2048, 2048]


def test_capacity_tree_finds_the_tightest_row():
    rng, tree, rooms = random.Random(7), CapacityTree(100), []
    for step in range(4000):
        length = rng.randint(1, 100)
        fits = sorted(r for r, _ in rooms if r >= length)
        if rng.random() < 0.5:
            found = tree.take(length)
            assert (found[0] if found else None) == (fits[0] if fits else None)
            if found:
                rooms.remove(found)
        else:
            tree.add(length, step)
            rooms.append((length, step))


def test_best_fit_loses_nothing():
    rng = random.Random(9)
    lengths = [rng.choice([0, 1, 5, 40, 99, 100, 101, 350]) for _ in range(300)]
    rows = best_fit_decreasing(lengths, 100)
    assert all(0 < sum(n for *_, n in row) <= 100 for row in rows)
    covered: dict = {}
    for row in rows:
        for item, start, n in row:
            covered.setdefault(item, []).append((start, n))
    for item, length in enumerate(lengths):
        at = 0
        for start, n in sorted(covered.get(item, [])):
            assert start == at
            at += n
        assert at == length
    assert len(rows) <= sum(lengths) / 100 * 1.1 + 1


def test_token_matrix(spark):
    docs = messy(spark)
    rows = token_matrix(docs, WORD, row_length=64, pad_id=7).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    parts: list = []
    for r in rows:
        ids, cu = np.frombuffer(r["ids"], "<u2"), r["cu_seqlens"]
        assert len(ids) == 64 and cu[-1] == r["n_tokens"] and r["position_resets"] == cu[:-1] and (ids[cu[-1] :] == 7).all()
        positions = position_ids(cu, 64)
        assert all(positions[s] == 0 for s in r["position_resets"])
        parts += [(d, s, ids[x:y].tolist()) for d, s, x, y in zip(r["doc_ids"], r["doc_starts"], cu, cu[1:])]
    by_id: dict = {}
    for d, s, ids in sorted(parts, key=lambda p: (p[0] is None, p[0] or 0, p[1])):
        by_id.setdefault(d, []).extend(ids)
    once = Counter(i for i, _ in texts_of(docs))
    for i, t in texts_of(docs):
        if once[i] == 1:
            assert by_id[i] == [*library_ids(WORD, t).tolist(), 1]
    assert token_matrix(empty(spark), WORD).count() == 0


def test_odd_white_space_goes_through_proposals():
    bpe = SpeculativeBpe(public_path("byte_bpe_50k.json"))
    whole, asked = bpe.encode_whole, []
    bpe.encode_whole = lambda text: asked.append(text) or whole(text)
    texts = ["One para.\n\nAnother  one,\twith tabs.\r\n", "  lead", "tail ", " ", "\n\n\n", "it's\n 'tis \xa0é\x1c", "zyxq" * 8000]
    for text, ids in zip(texts, bpe.encode_all(texts)):
        expected = bpe.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, ID_TYPE).tolist() == expected
    assert not asked
