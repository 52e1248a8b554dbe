"""A Merkle manifest of a dataset with checkpoint-and-recompute proofs.

Rows are the leaves, in one tree per value of a column and ordered by a key; the roots of these trees are the leaves of one
top tree. Every ``FANOUT`` neighbouring nodes are hashed into their parent. Only every ``STRIDE``-th level is stored: a
stored node covers an aligned subtree of ``FANOUT ** STRIDE`` stored nodes further down. A proof needs the levels between
too; they are computed again for one aligned subtree at a time, give the siblings of its nodes, and are dropped.

All of it is built-in functions. Groups are aligned subtrees, so none has more than ``FANOUT ** STRIDE`` rows however the rows
are spread over trees, and positions come from a range shuffle, not from a window over a tree.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import running_offsets, stored, table

FANOUT = 8
STRIDE = 3
SUBTREE = FANOUT**STRIDE
# Rows a sorting task takes, and trees whose numbers are broadcast at most, at some 100 bytes each.
ROWS_PER_TASK = 500_000
BROADCAST_TREES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(value: Column) -> Column:
    """Lowercase hex sha256 of a string's UTF-8 bytes."""
    return F.sha2(value.cast("binary"), 256)


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Digest of a row: each value as its byte count, ``:`` and itself in UTF-8, or ``-`` where it is NULL."""
    texts = [c.cast("string") for c in columns]
    sized = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return digest(F.concat(*[F.coalesce(s, F.lit("-")) for s in sized]))


@dataclass(frozen=True)
class Manifest:
    """``levels[i]`` holds the nodes of level ``i * STRIDE``: tree, position, size (leaves of the tree), digest. Level 0 has
    the carried columns of the leaves too. ``trees`` has one row per tree with its name, size, number, subroot; ``top``
    is the manifest of the subroots (None for the top tree itself), ``root`` one row, or none for no leaves."""

    levels: list[DataFrame]
    roots: DataFrame
    trees: DataFrame | None = None
    top: Manifest | None = None

    @property
    def root(self) -> DataFrame:
        return (self.top or self).roots.select(F.col("digest").alias("root"))


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``number``: their place (from 0) in the order of the columns, NULLs first. Ties are dealt by file and row of
    a stored copy, so they spread over tasks and a repeated task cannot move a number."""
    fixed = stored(rows, f"{name}-fixed")
    place = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    n = fixed.count()
    keys = [*order, "_file", "_row"]
    ranged = fixed.select("*", *place).repartitionByRange(max(1, -(-n // ROWS_PER_TASK)), *keys)
    ordered = stored(ranged.sortWithinPartitions(*keys).drop("_file", "_row"), f"{name}-ordered")
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("bigint").alias("_part")
    located = ordered.select("*", part, F.col("_metadata.row_index").alias("_row"))
    per_part = located.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per sorting task.
    before = running_offsets(per_part, "_part", "_n", "_before")
    return located.join(F.broadcast(before), "_part").select(*rows.columns, (F.col("_before") + F.col("_row")).alias("number"))


def level_size(size: Column, level: int) -> Column:
    """Nodes of a tree with ``size`` leaves at ``level``."""
    return F.ceil(size / float(FANOUT**level)).cast("bigint")


def levels_above(size: Column) -> Column:
    """Levels to recompute above ``size`` stored nodes of a tree: none above a single node, ``STRIDE`` at most."""
    steps = F.lit(0)
    for level in range(STRIDE):
        steps = F.when(level_size(size, level) > 1, level + 1).otherwise(steps)
    return steps


def parents(nodes: Column) -> Column:
    """The next level of an aligned subtree: every run of neighbours hashed."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(nodes, i * FANOUT + 1, FANOUT), "")))


def subtrees(level: DataFrame, step: int, carried: Sequence[str] = ()) -> DataFrame:
    """One row per aligned subtree of the stored level ``step``: tree, block, size, its members by position, and
    ``above``, the number of levels to its top."""
    own_size = level_size(F.col("size"), step * STRIDE)
    block = F.floor(F.col("position") / SUBTREE).cast("bigint").alias("block")
    members = F.sort_array(F.collect_list(F.struct("position", "digest", *carried))).alias("members")
    return level.groupBy("tree", block).agg(
        F.max("size").alias("size"), F.max(levels_above(own_size)).alias("above"), members
    )


def regenerated(rows: DataFrame) -> DataFrame:
    """Subtrees with the digests of their levels from the stored nodes up: ``l0`` to ``lS``; ``above`` tells the top."""
    rows = rows.withColumn("l0", F.transform("members", lambda m: m["digest"]))
    for i in range(STRIDE):
        rows = rows.withColumn(f"l{i + 1}", parents(F.col(f"l{i}")))
    return rows


def build(leaves: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels and the root of every tree, from leaves that know tree, position and size.

    All trees have the same stored levels; a tree that has ended goes on as its one node, unhashed.
    """
    levels, deepest = [leaves], leaves.agg(F.max("size")).first()[0] or 0
    top = F.element_at(F.element_at(F.array(*[F.col(f"l{i}") for i in range(STRIDE + 1)]), F.col("above") + 1), 1)
    while True:
        rows = regenerated(subtrees(levels[-1], len(levels) - 1))
        nodes = rows.select("tree", F.col("block").alias("position"), "size", top.alias("digest"))
        nodes = stored(nodes, f"{name}-level")
        if deepest <= SUBTREE ** len(levels):
            return levels, nodes.select("tree", "digest")
        levels.append(nodes)


def manifest(
    rows: DataFrame, tree: str, key: str, leaf: Column, carried: Mapping[str, Column] | None = None, name: str = "merkle"
) -> Manifest:
    """The manifest of ``rows``: a tree per value of ``tree`` (NULL is one), leaves ascending by ``key`` (NULLs first).

    Rows with the same key follow their digests, and equal digests are interchangeable: every place among them has the
    same leaf. ``carried`` columns go along with the leaves and into their proofs. No rows give no trees and no root.
    """
    carried = carried or {}
    named = {f"c_{c}": expr.alias(f"c_{c}") for c, expr in carried.items()}
    leaves = rows.select(F.col(tree).alias("name"), F.col(key).alias("key"), leaf.alias("digest"), *named.values())
    ordered = numbered(leaves, ["name", "key", "digest"], name)
    sizes = ordered.groupBy("name").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("size"))
    trees = stored(numbered(sizes, ["name"], f"{name}-trees").withColumnRenamed("number", "tree"), f"{name}-tree")
    small = F.broadcast(trees) if trees.count() <= BROADCAST_TREES else trees
    joined = ordered.join(small.withColumnRenamed("name", "tree_name"), F.col("name").eqNullSafe(F.col("tree_name")))
    position = (F.col("number") - F.col("first")).alias("position")
    levels, roots = build(stored(joined.select("tree", position, "size", "key", "digest", *named), f"{name}-leaves"), name)
    count = trees.count()
    top_leaves = roots.select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("position"), F.lit(count).cast("bigint").alias("size"), "digest"
    )
    top_levels, top_roots = build(top_leaves, f"{name}-top")
    found = trees.join(roots.withColumnRenamed("digest", "subroot"), "tree").select("tree", "name", "size", "subroot")
    return Manifest(levels, roots, found, Manifest(top_levels, top_roots))


def paths(levels: Sequence[DataFrame], carried: Sequence[str], above: DataFrame | None) -> DataFrame:
    """A proof for every node of level 0 up to its tree's root: tree, position, digest, the carried columns and ``proof``,
    an array with the place in the run and the siblings' digests (left to right, one string) for every level.

    ``above`` (tree, tail, and whatever else) is put behind. Works from the top: a stored level's subtrees take the proofs
    of their tops, which are nodes of the stored level over it.
    """
    extra = [c for c in above.columns if c not in ("tree", "tail")] if above is not None else []
    tails = above
    for step in range(len(levels) - 1, -1, -1):
        own = carried if step == 0 else ()
        rows = subtrees(levels[step], step, own)
        if tails is None:
            rows = rows.withColumn("tail", F.array().cast("array<struct<place:int,siblings:string>>"))
        elif step == len(levels) - 1:
            rows = rows.join(tails, "tree")
        else:
            rows = rows.join(tails.withColumnRenamed("position", "block"), ["tree", "block"])
        rows = regenerated(rows)

        def proof(j: Column) -> Column:
            found, at = [], j
            for i in range(STRIDE):
                run, place = F.slice(F.col(f"l{i}"), F.floor(at / FANOUT).cast("int") * FANOUT + 1, FANOUT), (at % FANOUT).cast("int")
                left, right = F.slice(run, F.lit(1), place), F.slice(run, place + 2, FANOUT)
                siblings = F.concat(F.array_join(left, ""), F.array_join(right, ""))
                found.append(F.struct(place.alias("place"), siblings.alias("siblings")))
                at = F.floor(at / FANOUT).cast("int")
            return F.slice(F.array(*found), F.lit(1), F.col("above"))

        # No subtree is copied for its members: the array of proofs is made in place, then exploded.
        member = lambda m, j: F.struct(m.alias("m"), F.concat(proof(j.cast("int")), F.col("tail")).alias("proof"))
        emitted = rows.select("tree", *extra, F.explode(F.transform("members", member)).alias("_x"))
        values = [F.col(f"_x.m.{c}").alias(c) for c in ("position", "digest", *own)]
        tails = emitted.select("tree", *extra, *values, F.col("_x.proof").alias("tail"))
        if step:
            tails = tails.drop("digest")
    return tails.withColumnRenamed("tail", "proof")


def proofs(found: Manifest, name: str = "merkle") -> DataFrame:
    """A proof for every leaf up to the root: tree, position, key, leaf, subroot, root, proof, and the carried columns."""
    above = paths(found.top.levels, (), None).select(
        F.col("position").alias("tree"), F.col("proof").alias("tail"), F.col("digest").alias("subroot")
    )
    # One row per tree; the number of trees is what bounds it.
    above = stored(above, f"{name}-tails")
    above = F.broadcast(above) if above.count() <= BROADCAST_TREES else above
    carried = [c for c in found.levels[0].columns if c not in ("tree", "position", "size", "digest")]
    root = found.root.scalar() if found.root.limit(1).count() else F.lit(None).cast("string")
    rows = paths(found.levels, carried, above).withColumnRenamed("digest", "leaf").withColumn("root", root)
    return rows.withColumnsRenamed({c: c[2:] for c in carried if c.startswith("c_")})


def folded(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    at = lambda x: F.lit(64) * x["place"]
    step = lambda acc, x: digest(
        F.concat(F.substring(x["siblings"], F.lit(1), at(x)), acc, F.substring(x["siblings"], at(x) + 1, F.length(x["siblings"])))
    )
    return F.aggregate(proof, leaf, step)


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level."""
    return digest(F.array_join(F.transform(proof, lambda x: x["siblings"]), ""))


def op12_merkle_proofs(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    columns = lambda t: [F.col("doc_id").cast("bigint"), F.col("source"), F.col("lang"), F.col("n_chars"), t]
    changed = F.when(tampered, leaf_digest(columns(F.translate(text, UPPER, LOWER))))
    rows = proofs(manifest(docs, "lang", "doc_id", leaf_digest(columns(text)), {"changed": changed}))
    refolded = folded(F.coalesce(F.col("changed"), F.col("leaf")), F.col("proof"))
    out = rows.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
        refolded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _op12_sql(depth: int = 8, top_depth: int = 4) -> str:
    """Trees of up to ``8 ** depth`` leaves, level by level."""
    crc = (
        "xor(4294967295, list_reduce(range(0, 8 * length(k)), lambda c, i: CASE WHEN (x(c, i, k) & 1) = 1 "
        "THEN xor(x(c, i, k) >> 1, 3988292384) ELSE x(c, i, k) >> 1 END, 4294967295))"
    )
    step = "(CASE WHEN i % 8 = 0 THEN xor(c, CAST(ascii(substr(k, CAST(i // 8 + 1 AS INTEGER), 1)) AS BIGINT)) ELSE c END)"
    crc = crc.replace("x(c, i, k)", step).replace("4294967295", "CAST(4294967295 AS BIGINT)")
    crc = crc.replace("3988292384", "CAST(3988292384 AS BIGINT)")
    part = lambda v: f"coalesce(octet_length(encode(CAST({v} AS VARCHAR))) || ':' || {v}, '-')"
    leaf = lambda t: "sha256(" + " || ".join(part(v) for v in ("doc_id", "source", "lang", "n_chars", t)) + ")"
    ctes = [
        "d AS (SELECT *, CAST(doc_id AS VARCHAR) AS k FROM documents)",
        f"e AS (SELECT doc_id, lang AS name, {leaf('text')} AS h, coalesce({crc} % 3 = 0, FALSE) AS tampered, "
        f"{leaf(f'translate(text, {UPPER!r}, {LOWER!r})')} AS t FROM d)",
        "n0 AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, "
        "count(*) OVER (PARTITION BY name) AS n, CASE WHEN tampered THEN t ELSE h END AS f FROM e)",
        "m0 AS (SELECT name, pos, n, h FROM n0)",
    ]

    def levels(base: str, count: int) -> None:
        for i in range(count):
            ctes.append(
                f"{base}{i + 1} AS (SELECT name, pos // 8 AS pos, CAST(ceil(max(n) / 8.0) AS BIGINT) AS n, "
                f"CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h "
                f"FROM {base}{i} GROUP BY name, pos // 8)"
            )
            ctes.append(
                f"{base}s{i} AS (SELECT a.name, a.pos, a.n, "
                "coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, "
                "coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r "
                f"FROM {base}{i} a JOIN {base}{i} b ON a.name IS NOT DISTINCT FROM b.name AND a.pos // 8 = b.pos // 8 "
                "GROUP BY a.name, a.pos, a.n)"
            )

    def folds(prefix: str, source: str, base: str, count: int) -> str:
        for i in range(count):
            ctes.append(
                f"{prefix}{i} AS (SELECT x.* EXCLUDE (p, f, pos), x.pos // 8 AS pos, x.p || s.l || s.r AS p, "
                f"CASE WHEN s.n = 1 THEN x.f ELSE sha256(s.l || x.f || s.r) END AS f "
                f"FROM {source} x JOIN {base}s{i} s ON x.pos = s.pos AND x.name IS NOT DISTINCT FROM s.name)"
            )
            source = f"{prefix}{i}"
        return source

    levels("m", depth)
    ctes.append(
        f"t0 AS (SELECT 0 AS name, row_number() OVER (ORDER BY encode(name) NULLS FIRST) - 1 AS pos, "
        f"count(*) OVER () AS n, h, name AS tree FROM m{depth})"
    )
    levels("t", top_depth)
    ctes.append("p AS (SELECT doc_id, h AS leaf, name, pos, '' AS p, f FROM n0)")
    last = folds("p", "p", "m", depth)
    ctes.append(
        f"q AS (SELECT x.doc_id, x.leaf, x.p, x.f, t.h AS subroot, t.pos, 0 AS name "
        f"FROM {last} x JOIN t0 t ON x.name IS NOT DISTINCT FROM t.tree)"
    )
    last = folds("q", "q", "t", top_depth)
    return (
        f"WITH {', '.join(ctes)} SELECT x.doc_id, x.leaf, x.subroot, t.h AS root, sha256(x.p) AS proof_sha256, "
        f"x.f AS folded_root, x.f = t.h AS verified FROM {last} x JOIN t{top_depth} t ON TRUE"
    )


OP12_SQL = _op12_sql()
