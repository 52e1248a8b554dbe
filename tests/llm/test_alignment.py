"""Cross-tokenizer alignment against both libraries on whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from parcelmart.llm.alignment import Aligner, PairCounts, align_documents, build_hash, pair_table
from parcelmart.llm.tokens import public_path
from tests.llm.messy import empty, messy, texts_of

PATHS = public_path("byte_bpe_50k.json"), public_path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def both() -> Aligner:
    return Aligner(*PATHS)


def brute(both, text):
    """Groups and links of a text encoded whole; None where it has no tokens."""
    if not text:
        return None
    raw = f" {text}".encode()
    spans = []
    for ids, entries in ((both.a.encode(f" {text}", add_special_tokens=False).ids, both.bytes_a), (both.b.encode(text), both.bytes_b)):
        if b"".join(entries[i] for i in ids) != raw:
            return None
        ends = np.cumsum([len(entries[i]) for i in ids]).tolist()
        spans.append(list(zip(ids, [0, *ends], ends)))
    a, b = spans
    cuts = {e for _, _, e in a} & {e for _, _, e in b}
    sides = []
    for side in spans:
        groups, held = [], []
        for i, _, e in side:
            held.append(str(i))
            if e in cuts:
                groups.append(",".join(held))
                held = []
        sides.append(groups)
    groups = ["|".join(pair) for pair in zip(*sides)]
    links, at = [], 0
    for i, s, e in a:
        while b[at][2] <= s:
            at += 1
        k = at
        while k < len(b) and b[k][1] < e:
            links.append((i, b[k][0]))
            k += 1
    return len(a), len(b), ";".join(groups), links


def expected(both, rows):
    found = [(i, brute(both, t)) for i, t in rows]
    count = Counter(link for _, f in found if f for link in set(f[3]))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = Counter()
    for i, f in found:
        if not f:
            out[i, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        n_a, n_b, groups, links = f
        best, total = sum(count[x] == top[x[0]] for x in links), sum(count[x] for x in links)
        sha = hashlib.sha256(groups.encode()).hexdigest()
        out[i, n_a, n_b, groups.count(";") + 1, len(links), best, total, sha] += 1
    return out, count


@pytest.mark.parametrize("limit", [4_000_000, 0], ids=["broadcast", "join"])
def test_messy_documents(spark, both, limit):
    docs = messy(spark)
    want, _ = expected(both, texts_of(docs))
    got = align_documents(docs, *PATHS, with_groups=True, broadcast_pairs=limit).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == want
    assert all(r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") for r in got)
    assert align_documents(empty(spark), *PATHS, broadcast_pairs=limit).count() == 0


def test_pair_counts(spark, both):
    docs = messy(spark)
    _, want = expected(both, texts_of(docs))
    table = pair_table(docs, *PATHS)
    assert table.pairs == len(want)
    assert {(r["a"], r["b"]): r["n"] for r in table.counts().collect()} == dict(want)


def test_units_are_encoded_as_in_the_whole_text(both):
    rng = random.Random(1)
    texts = ["  a x  b", "x y", " x  y ", "\x1c a b \x85 c", "<|endoftext|> a<|endoftext|>b <s> <0x41>", "日本 語  🎉", "x ▁y"]
    texts += ["".join(rng.choice("ab \n\t,.'s1é▁  　") for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    for text in texts:
        units = both.units(text)
        assert "".join(f" {u}" for u in units) == f" {text}"
        found, want = both.align(units), brute(both, text)
        assert bool(found.valid.all()) == (want is not None), text
        assert want is None or ";".join(found.texts) == want[2], text


def test_a_word_of_a_million_letters(both):
    text = "ab" * 500_000
    found = both.align(both.units(text))
    assert found.valid.all() and found.n_a.sum() == len(both.a.encode(f" {text}", add_special_tokens=False).ids)


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(4)
    pairs = np.unique(rng.integers(0, 1 << 48, 20_000))
    sizes, words, keys = build_hash(pairs)
    assert sorted(keys.tolist()) == pairs.tolist()
    row = {"bucket": 0, "sizes": sizes, "words": words.tobytes(), "keys": keys.astype("<i8").tobytes()}
    counts = PairCounts([row | {"counts": np.arange(1, len(keys) + 1).astype("<i8").tobytes()}], 1)
    slots = counts.hash.slots(pairs, np.zeros(len(pairs), np.int64))
    assert sorted(slots.tolist()) == list(range(len(pairs))) and (keys[slots] == pairs).all()
    strange = np.setdiff1d(rng.integers(0, 1 << 48, 5000), pairs)
    assert counts.find(strange)[0].sum() == 0
    assert len(build_hash(np.zeros(0, np.int64))[2]) == 0


@pytest.mark.parametrize("limit", [4_000_000, 0], ids=["broadcast", "join"])
def test_documents_are_encoded_once(spark, limit):
    """The result's own plan has no text in it: what it needs of the tokenizers was kept by the first pass."""
    docs = spark.createDataFrame([(1, "one text of words"), (1, "and another"), (None, None)], "doc_id long, text string")
    plan = align_documents(docs, *PATHS, broadcast_pairs=limit)._jdf.queryExecution().optimizedPlan().toString()
    assert "links_a" in plan and "text" not in plan.replace("TextFile", "")
