"""Exact and near duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from parcelmart.llm import jaccard_join
from parcelmart.llm.components import components
from parcelmart.llm.exact_dedup import Trie, drop_exact_duplicates, exact_duplicates, payloads, prepared, trie_owners
from parcelmart.llm.jaccard_join import CountTree, counts, jaccard_components, keep_one_of_each, needed, points_of, shingle_sets, tree_links, tree_pairs
from tests.llm.messy import empty, messy, texts_of


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_duplicates(spark, keep):
    docs = messy(spark)
    groups = defaultdict(list)
    for i, t in texts_of(docs):
        groups[lower(t)].append(i)
    best = max if keep == "largest" else min
    owner = {t: best((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    rows = exact_duplicates(docs, keep).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = Counter((i, owner[t], len(ids), sha(t)) for t, ids in groups.items() for i in ids)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows) == expected
    kept = Counter(r["text_sha256"] for r in rows if r["kept"])
    assert kept == Counter(map(sha, groups))
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])
    left = drop_exact_duplicates(docs, keep)
    assert left.columns == docs.columns
    assert Counter(lower(t) for _, t in texts_of(left)) == Counter(groups.keys())
    assert drop_exact_duplicates(empty(spark)).count() == exact_duplicates(empty(spark)).count() == 0


def test_trie_and_its_spill():
    rng, trie, seen = random.Random(2), Trie(), {}
    for k in range(3000):
        key = bytes(rng.choice(b"ab\xc3") for _ in range(rng.randint(0, 12)))
        payload, new = trie.find_or_add(key)
        assert new == (key not in seen)
        payload.append(k)
        seen.setdefault(key, payload)
        assert payload is seen[key]
    spilled = list(trie.spill())
    left = list(payloads(trie.root))
    assert spilled and len(spilled) + len(left) == len(seen)
    while trie.bytes:
        assert list(trie.spill())
    assert not list(payloads(trie.root))


def test_spilling_changes_nothing(spark):
    docs = messy(spark).unionByName(messy(spark))
    carriers = prepared(docs, 1, "doc_id", "text", False).filter("n IS NOT NULL")
    small, large = (sorted(map(tuple, trie_owners(carriers, 1, b).select("sha", "keep_id", "group_size").collect())) for b in (500, 1 << 20))
    assert small == large and sum(n for *_, n in small) == docs.count()


def brute_components(docs, words: int, percent: int) -> dict:
    sets, link = {}, {}
    for i, t in docs:
        w = re.findall("[^\x20\x09-\x0d]+", lower(t))
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
        link[i] = i

    def find(i):
        while link[i] != i:
            i = link[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                link[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def brute_linked(a: set, b: set, percent: int) -> bool:
    return 100 * len(a & b) >= percent * len(a | b)


def families(seed: int) -> list[tuple[int, str | None]]:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    texts: list[str | None] = ["", None, " ", "a", "A", "a b", "x " * 300]
    for _ in range(35):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 7, 9, 12, 20, 40, 90, 200]))]
        for _ in range(rng.randint(1, 8)):
            new = list(base)
            for _ in range(rng.randint(0, max(1, len(new) // 20))):
                at = rng.randrange(len(new))
                new[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)]
            base = new if rng.random() < 0.6 else base  # chains as well as stars
            texts.append(" ".join(new))
    rng.shuffle(texts)
    return [(7 * k, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80), (1, 50)])
def test_jaccard_components(spark, words, percent):
    docs = families(words)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = {r[0]: (r[1], r[2]) for r in jaccard_components(frame, words, percent).collect()}
    assert found == brute_components(docs, words, percent)


def test_round_two_joins_what_leaders_miss(spark):
    """A shared passage makes cells of unrelated documents; links among their later members must still be found."""
    passage = " ".join(f"p{i}" for i in range(60))
    docs = []
    for k in range(60):
        tail = " ".join(f"t{k // 3}x{j}" for j in range(22))
        docs.append((k, f"{passage} {tail}" + (f" z{k}" if k % 3 else "")))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = {r[0]: (r[1], r[2]) for r in jaccard_components(frame, 4, 85).collect()}
    assert found == brute_components(docs, 4, 85)


@pytest.mark.parametrize("block", [1024, 5])
def test_blocks_of_a_large_cell(spark, monkeypatch, block):
    """All documents in one cell, most of them one component: no link between components is lost, few leave a task."""
    monkeypatch.setattr(jaccard_join, "CELL_BLOCK", block)
    rng = random.Random(block)
    base, docs = [f"w{i}" for i in range(120)], []
    for k in range(90):
        text = list(base)
        for at in rng.sample(range(120), rng.choice([1, 1, 1, 1, 5])):
            text[at] = f"x{rng.randrange(9)}"
        docs.append((k, " ".join(text)))
    expected = brute_components(docs, 4, 85)
    # Two thirds of the cell are known to be in one component, as far as they are.
    hub = Counter(c for _, c in expected.values()).most_common(1)[0][0]
    known = [(0, i, hub if c == hub and i % 3 else i) for i, (_, c) in expected.items()]
    frame = spark.createDataFrame(docs, "id long, text string")
    sets = shingle_sets(frame, 4)
    members = spark.createDataFrame(known, "key long, id long, component long").join(sets.select("id", "n"), "id")
    links = [tuple(r) for r in tree_links(members, sets, 85).collect()]
    left = tree_pairs(members, sets, 85).collect()
    of, shingles = dict(r[1:] for r in known), {r["id"]: set(np.frombuffer(r["shingles"], "<u8")) for r in sets.collect()}
    need = {(a, b) for a in of for b in of if a < b and of[a] != of[b] and brute_linked(shingles[a], shingles[b], 85)}
    named, single = {tuple(sorted(r[1:])) for r in left if r["b"] is not None}, {r["a"] for r in left if r["b"] is None}
    assert all(pair in named or single.issuperset(pair) for pair in need) and single
    merged = {i: part for _, i, part in known}
    if block == 1024:
        assert len(links) < len(set(merged.values()))
    for a, b in links:
        low, high = sorted((merged[a], merged[b]))
        merged = {i: low if part == high else part for i, part in merged.items()}
    groups = lambda parts: Counter(frozenset(i for i in parts if parts[i] == p) for p in parts.values())
    assert groups(merged) == groups({i: c for i, (_, c) in expected.items()})


def test_crowds_share_members(spark):
    rows = [(1, 5), (1, 6), (2, 6), (2, 9), (3, 20), (3, 21), (4, 30)]
    found = dict(tuple(r) for r in jaccard_join.crowds(spark.createDataFrame(rows, "key long, id long")).collect())
    assert found == {5: 5, 6: 5, 9: 5, 20: 20, 21: 20, 30: 30}


@pytest.mark.parametrize("per_member", [0, 2])
def test_crowds_lose_no_link(spark, monkeypatch, per_member):
    """Stragglers of a large family that the rounds before do not settle, named as pairs and as crowds."""
    inner = jaccard_join.tree_pairs
    monkeypatch.setattr(jaccard_join, "tree_pairs", lambda m, s, p: named_as_crowds(inner(m, s, p)) if not per_member else inner(m, s, p))
    rng, docs = random.Random(3), []
    passage = [f"p{i}" for i in range(60)]
    for k in range(60):
        tail = [f"t{k // 6}x{j}" for j in range(22)]
        tail[rng.randrange(22)] = f"z{k}"
        docs.append((k, " ".join(passage + tail)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = {r[0]: (r[1], r[2]) for r in jaccard_components(frame, 4, 85).collect()}
    assert found == brute_components(docs, 4, 85)


def named_as_crowds(left):
    named = left.filter("b IS NOT NULL")
    return left.filter("b IS NULL").union(named.selectExpr("key", "a", "NULL")).union(named.selectExpr("key", "b", "NULL"))


def test_counts_beyond_16_bits():
    wide = np.arange(70_000, dtype=np.uint64) * np.uint64(jaccard_join.GROUPS)
    points = points_of([counts(wide).tobytes(), counts(wide[:9]).tobytes()])
    assert points[:, 0].tolist() == [70_000, 9] and points.sum() == 70_009


def test_near_duplicates_of_messy_rows(spark):
    docs = messy(spark)
    rows = jaccard_components(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r["component_id"] for r in rows}
    assert by_id[5] == by_id[6] == by_id[7] == 5 and by_id[None] is None and by_id[2] == 2 and by_id[3] == 3
    left = keep_one_of_each(docs)
    assert left.columns == docs.columns
    assert Counter(i for i, _ in texts_of(left)) == Counter(i for i, _ in texts_of(docs) if i not in (6, 7, 14))  # 14 has the words of 11
    assert jaccard_components(empty(spark)).count() == 0


def test_tree_finds_all_the_bound_allows():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 120)).astype(np.uint64)) for _ in range(500)]
    points, sizes = np.array([counts(s) for s in sets]), np.array([len(s) for s in sets])
    tree = CountTree(points, sizes)
    for i in range(0, 500, 25):
        bound = np.minimum(points, points[i]).sum(axis=1, dtype=np.int64) >= needed(sizes, sizes[i], 50)
        assert sorted(tree.search(points[i], sizes[i], 50)) == np.flatnonzero(bound).tolist()


def test_components_of_chains(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7), (None, 3), (200, 201), (201, 200)]
    found = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert found == {**{k: 0 for k in range(1, 41)}, 100: 90, 95: 90, 201: 200}


def test_cells_and_sets_are_deleted(spark):
    from parcelmart.session import work_dir
    from parcelmart.sources.commits import folders

    before = set(folders(spark, work_dir(spark)))
    docs = spark.createDataFrame([(i, f"the same words but for the last one {i % 2}") for i in range(8)], "doc_id long, text string")
    found = jaccard_components(docs, words=2, percent=50)
    left = {name.rsplit("-", 1)[0] for name in set(folders(spark, work_dir(spark))) - before}
    assert "llm-members" in left and not {"llm-cells", "llm-sets"} & left
    assert {tuple(r) for r in found.collect()} == {(i, 8, 0) for i in range(8)}
