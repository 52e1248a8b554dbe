"""Merkle manifests against a plain tree, and proofs against tampering."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from parcelmart.llm import merkle
from parcelmart.llm.merkle import folded, leaf_digest, manifest, proof_digest, proofs
from tests.llm.messy import empty, messy


def h(*values: str) -> str:
    return hashlib.sha256("".join(values).encode()).hexdigest()


def plain_leaf(*values) -> str:
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes: list[str]) -> list[list[str]]:
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([h(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return found


def path(found: list[list[str]], at: int) -> list[str]:
    out = []
    for level in found[:-1]:
        run = level[at // 8 * 8 : at // 8 * 8 + 8]
        out += run[: at % 8] + run[at % 8 + 1 :]
        at //= 8
    return out


def brute(rows: list[tuple]) -> tuple[Counter, str | None]:
    """(name, key, leaf, subroot, root, digest of siblings) of rows (name, key, leaf)."""
    trees = defaultdict(list)
    for name, key, leaf in rows:
        trees[name].append((key is not None, key or 0, leaf))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    built = [levels([leaf for *_, leaf in sorted(trees[n])]) for n in names]
    top = levels([b[-1][0] for b in built]) if built else [[None]]
    out = Counter()
    for i, (name, b) in enumerate(zip(names, built)):
        for at, (known, key, leaf) in enumerate(sorted(trees[name])):
            out[name, key if known else None, leaf, b[-1][0], top[-1][0], h(*path(b, at), *path(top, i))] += 1
    return out, top[-1][0]


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(merkle, "ROWS_PER_TASK", 400)


def frame(spark, rows):
    return spark.createDataFrame(rows, "name string, key long, text string").withColumn("leaf", leaf_digest([F.col("key"), F.col("text")]))


@pytest.mark.parametrize("broadcast", [100_000, 0], ids=["broadcast", "join"])
def test_trees_of_all_sizes(spark, small_tasks, monkeypatch, broadcast):
    monkeypatch.setattr(merkle, "BROADCAST_TREES", broadcast)
    rng = random.Random(7)
    sizes = {"a": 1, "b": 2, "ä": 8, "c": 9, "Z": 64, "": 65, "d": 512, None: 513, "e": 1100} | {f"t{i}": 1 for i in range(12)}
    rows = [(name, rng.randrange(10_000), f"text {rng.random()}") for name, n in sizes.items() for _ in range(n)]
    rng.shuffle(rows)
    found = manifest(frame(spark, rows), "name", "key", F.col("leaf"))
    got = proofs(found).join(found.trees.select("tree", "name"), "tree")
    got = got.withColumn("sha", proof_digest(F.col("proof"))).withColumn("again", folded(F.col("leaf"), F.col("proof")))
    want, root = brute([(n, k, plain_leaf(k, t)) for n, k, t in rows])
    listed = got.select("name", "key", "leaf", "subroot", "root", "sha", "again").collect()
    assert Counter(tuple(r)[:6] for r in listed) == want
    assert {r["again"] for r in listed} == {root} and found.root.first()[0] == root
    assert len(found.levels) == 2  # of a depth of four, leaves and level three are stored


def test_tampering_shows(spark):
    docs = messy(spark)
    leaf = leaf_digest([F.col("doc_id"), F.col("text")])
    changed = leaf_digest([F.col("doc_id"), F.concat("text", F.lit("!"))])
    rows = proofs(manifest(docs, "lang", "doc_id", leaf, {"changed": changed, "text": F.col("text")}))
    rows = rows.select("text", "root", "leaf", folded(F.col("changed"), F.col("proof")).alias("other")).collect()
    assert len(rows) == docs.count()
    assert all((r["other"] == r["root"]) == (r["text"] is None) for r in rows)


def test_messy_documents_and_none(spark):
    docs = messy(spark)
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    want, _ = brute([(r["lang"], r["doc_id"], plain_leaf(*(r[c] for c in columns))) for r in docs.collect()])
    found = manifest(docs, "lang", "doc_id", leaf_digest([F.col(c) for c in columns]))
    got = proofs(found).withColumn("sha", proof_digest(F.col("proof"))).join(found.trees.select("tree", "name"), "tree")
    assert Counter(tuple(r) for r in got.select("name", "key", "leaf", "subroot", "root", "sha").collect()) == want
    nothing = manifest(empty(spark), "lang", "doc_id", leaf_digest([F.col("text")]))
    assert nothing.root.count() == proofs(nothing).count() == 0


def test_repeated_rows_have_proofs_of_their_own(spark):
    rows = [("a", 1, "same")] * 600 + [("a", None, None)] * 3
    got = proofs(manifest(frame(spark, rows), "name", "key", F.col("leaf")))
    got = got.select("position", "root", folded(F.col("leaf"), F.col("proof")).alias("again")).collect()
    assert sorted(r["position"] for r in got) == list(range(603)) and all(r["root"] == r["again"] for r in got)
