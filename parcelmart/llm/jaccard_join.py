"""Join of documents by Jaccard similarity of their word shingles, with count vectors in R-trees.

Shingles are hashed into groups. Two documents whose sets differ in at most T shingles agree entirely on at least one of
T + 1 groups, so documents meet in cells: one per group and content of that group. A cell keeps only its smallest
document for the shuffle and links the others of its block to it. Inside cells documents are points, their numbers of
shingles per group: the sum of coordinate minima bounds the overlap of two sets from above, and R-trees over the points
discard what cannot be similar. What is left is verified on the sets.

Links are sought in rounds. The first tests each document against one leader of its cells, so a group of many near
copies costs one test each. The next two test the pairs with other leaders that are not yet in one component; these
are bounded pair by pair. The last takes the cells that still lie in several components: trees over their points
leave pairs of different components, which are verified like all others. Where these are many, the members' sets are
brought together instead, once for all cells that share members: the trees propose, the sets decide, and only links that
join two components leave the task. No pair is skipped that could join two components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from parcelmart.llm.common import stored, table, text_batches
from parcelmart.llm.components import components
from parcelmart.session import work_table

GROUPS = 256
# Words remembered per Python worker, and documents per node of a tree.
CACHE_WORDS = 100_000
LEAF = 16
# Members of a cell in one block of the last round, and bytes of a block's sets held at once.
CELL_BLOCK = 1024
BLOCK_BYTES = 12 << 20
# Bytes of texts, or of rows with sets or points, that a task works on at once; beside them it holds several times as much.
TEXT_BYTES = 4 << 20
# Pairs that a pair of blocks names for each row it holds; of more, it names the members only.
PAIRS_PER_MEMBER = 2
# Ids of candidate documents that are broadcast at most (8 bytes each).
BROADCAST_IDS = 1_000_000
BAND_RATIO = 1.6
U64 = np.uint64
# Odd constants that mix hashes.
MIX = [U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0xD6E8FEB86659FD93)]
EMPTY = U64(0xA5A5A5A5A5A5A5A5)
CELLS = "kind int, key bigint, id bigint, leader bigint, members bigint"
SETS = "id bigint, n bigint, counts binary, shingles binary"


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * MIX[1]
        x = (x ^ (x >> U64(27))) * MIX[2]
        return x ^ (x >> U64(31))


class Shingler:
    """Sets of hashed word shingles; words are told apart by 64-bit hashes."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.cache: dict[bytes, int] = {}

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingles of a text in lower case (A-Z only); a short text is one shingle, none is none."""
        import xxhash

        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, U64)
        cache, n = self.cache, len(words)
        try:
            ids = np.fromiter(map(cache.__getitem__, words), U64, n)
        except KeyError:
            if len(cache) > CACHE_WORDS:
                cache.clear()
            for w in words:
                if w not in cache:
                    cache[w] = xxhash.xxh3_64_intdigest(w)
            ids = np.fromiter(map(cache.__getitem__, words), U64, n)
        width = min(self.words, n)
        with np.errstate(over="ignore"):
            found = np.full(n - width + 1, U64(width), U64)
            for k in range(width):
                found = mix(found * MIX[0] + ids[k : n - width + 1 + k])
        return np.unique(found)


@lru_cache(maxsize=2)
def shingler(words: int) -> Shingler:
    return Shingler(words)


class Bands:
    """Size bands and their numbers of groups for links with 100 * intersection >= percent * union."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        # Below the first edge only equal sets can be linked.
        self.first = -(-percent // (100 - percent))
        self.edges = [self.first]

    def differing(self, smaller: int) -> int:
        """Most shingles in which a linked pair can differ, given the size of its smaller set."""
        return smaller * (100 - self.percent) // self.percent

    def band(self, n: int) -> int:
        while self.edges[-1] <= n:
            self.edges.append(int(self.edges[-1] * BAND_RATIO) + 1)
        return int(np.searchsorted(self.edges, n, side="right")) - 1

    def groups(self, band: int) -> tuple[int, int]:
        """Number of groups of a band, and how many of its smallest groups a set may leave out.

        Linked sets agree on more than ``spare`` groups, and these have the same sizes in both. Leaving out the
        smallest groups in an order that both sets share, each loses at most ``spare`` of them, and the set that leaves
        out the larger sizes decides: one at least stays in both. Small groups are what unrelated texts share.
        """
        most = self.differing(self.edges[band + 1] - 1)
        spare = 2 + (most + 1) // 4
        return most + 1 + spare, spare

    def cells(self, shingles: np.ndarray) -> np.ndarray:
        """Keys of the cells of a set: any set it can be linked to has one of them."""
        n = len(shingles)
        if not n:
            return np.empty(0, U64)
        hashed = mix(shingles + MIX[3])
        with np.errstate(over="ignore"):
            if n < self.first:
                return mix(np.array([hashed.sum(dtype=U64) + U64(n)], U64))
            keys = []
            least = -(-n * self.percent // 100)  # the smallest partner
            for band in range(self.band(max(least, self.first)), self.band(n) + 1):
                m, spare = self.groups(band)
                group = (shingles % U64(m)).astype(np.int64)
                content = np.zeros(m, U64)
                np.add.at(content, group, hashed)
                held = np.bincount(group, minlength=m)
                content[held == 0] = EMPTY
                place = np.arange(m, dtype=U64) * MIX[0] + U64(band + 1) * MIX[3]
                keys.append(mix(mix(content) + place)[np.argsort(held, kind="stable")[spare:]])
        return np.concatenate(keys)


def needed(n: np.ndarray | int, m: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Least intersection of linked sets of these sizes."""
    return -(-percent * (n + m) // (100 + percent))


def counts(shingles: np.ndarray) -> np.ndarray:
    """The set as a point: its number of shingles in each group, in 16 bits where they fit."""
    held = np.bincount((shingles % U64(GROUPS)).astype(np.int64), minlength=GROUPS)
    return held.astype("<u2" if held.max() < 1 << 16 else "<u4")


def points_of(column: list[bytes]) -> np.ndarray:
    """Points side by side; with a 32-bit one among them all become such."""
    if all(len(c) == 2 * GROUPS for c in column):
        return np.frombuffer(b"".join(column), "<u2").reshape(-1, GROUPS)
    wide = [np.frombuffer(c, f"<u{len(c) // GROUPS}").astype("<u4") for c in column]
    return np.stack(wide)


class CountTree:
    """R-tree over count vectors, packed by sorting on the widest coordinate; nodes know their upper corners."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.order = self._packed(points, np.arange(len(points)))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = [(self.points, self.sizes)]
        while len(self.levels[-1][0]) > LEAF:
            upper, least = self.levels[-1]
            starts = np.arange(0, len(upper), LEAF)
            self.levels.append((np.maximum.reduceat(upper, starts, axis=0), np.minimum.reduceat(least, starts)))

    @staticmethod
    def _packed(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if len(rows) <= LEAF:
            return rows
        part = points[rows]
        rows = rows[np.argsort(part[:, np.argmax(part.max(0) - part.min(0))], kind="stable")]
        half = -(-len(rows) // (2 * LEAF)) * LEAF
        return np.concatenate([CountTree._packed(points, rows[:half]), CountTree._packed(points, rows[half:])])

    def search(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Rows whose summed coordinate minima with the point reach what a link needs."""
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, least = self.levels[depth]
            bound = np.minimum(upper[at], point).sum(axis=1, dtype=np.int64)
            at = at[bound >= needed(size, least[at], percent)]
            if depth:
                below = len(self.levels[depth - 1][0])
                at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
                at = at[at < below]
        return self.order[at]


def cell_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Rows of three kinds: documents (0) with their set sizes and the smallest local id of an equal set, cells (1) of
    each block's smallest document, and the block's other members (2) of a cell."""
    schema = to_arrow_schema(_parse_datatype_string(CELLS))

    def batch_of(kind: int, key, ids, leader, members) -> pa.RecordBatch:
        columns = [np.full(len(ids), kind, np.int32), key, ids, leader, members]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, bands = shingler(words), Bands(percent)
        for batch in text_batches(batches, TEXT_BYTES):
            ids = batch.column(0).to_pylist()
            sizes, sets = [], []
            first: dict[bytes, int] = {}
            where: dict[bytes, np.ndarray] = {}
            import xxhash

            for i, text in zip(ids, batch.column(1).to_pylist()):
                found = maker.shingles(text)
                sizes.append(len(found))
                name = xxhash.xxh3_128_digest(found.tobytes())
                sets.append(name if len(found) and i is not None else None)
                if sets[-1] is not None:
                    if name not in first:
                        where[name] = bands.cells(found)
                    first[name] = min(first.get(name, i), i)
            reps = [i if name is None else first[name] for i, name in zip(ids, sets)]
            yield batch_of(0, pa.array(sizes, pa.int64()), ids, reps, [None] * len(ids))
            if not where:
                continue
            keys = np.concatenate(list(where.values())).view(np.int64)
            owners = np.repeat(np.fromiter((first[n] for n in where), np.int64), [len(k) for k in where.values()])
            order = np.lexsort((owners, keys))
            keys, owners = keys[order], owners[order]
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            held = np.diff(np.append(starts, len(keys)))
            # In order of ids, which then take hardly any room.
            by_owner = np.argsort(owners[starts], kind="stable")
            step = 1 << 18
            for s in range(0, len(starts), step):
                part = by_owner[s : s + step]
                yield batch_of(1, keys[starts[part]], owners[starts[part]], pa.nulls(len(part), pa.int64()), held[part])
            others = np.ones(len(keys), bool)
            others[starts] = False
            if others.any():
                yield batch_of(2, keys[others], owners[others], np.repeat(owners[starts], held)[others], np.repeat(held, held)[others])

    return docs.mapInArrow(run, CELLS)


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """Set, size and point of every row."""
    schema = to_arrow_schema(_parse_datatype_string(SETS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = shingler(words)
        for batch in text_batches(batches, TEXT_BYTES):
            sets = [maker.shingles(t) for t in batch.column(1).to_pylist()]
            columns = [[len(s) for s in sets], [counts(s).tobytes() for s in sets], [s.tobytes() for s in sets]]
            arrays = [batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return docs.mapInArrow(run, SETS)


def _both_sides(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    for side in ("a", "b"):
        named = sets.select(F.col("id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])
        pairs = pairs.join(named, side)
    return pairs


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) that are linked: first by the bound on their points, then on their sets."""
    schema = to_arrow_schema(_parse_datatype_string("a bigint, b bigint"))

    def chosen(batch: pa.RecordBatch, keep: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in batch.columns[:2]], schema=schema)

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, TEXT_BYTES):
            n, m = (batch.column(k).to_numpy() for k in (2, 4))
            x, y = (points_of(batch.column(k).to_pylist()) for k in (3, 5))
            yield chosen(batch, np.minimum(x, y).sum(axis=1, dtype=np.int64) >= needed(n, m, percent))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, TEXT_BYTES):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                keep.append(int((y[at] == x).sum()) >= needed(len(x), len(y), percent))
            yield chosen(batch, np.array(keep, bool))

    points = _both_sides(pairs, sets, "n", "counts").select("a", "b", "a_n", "a_counts", "b_n", "b_counts")
    left = points.mapInArrow(bound, "a bigint, b bigint").distinct()
    return _both_sides(left, sets, "shingles").select("a", "b", "a_shingles", "b_shingles").mapInArrow(exact, "a bigint, b bigint")


def open_cells(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members (key, id, component) of cells that lie in several components and have more than the pair tested already.

    Of cells with the same members one is enough; sets of members are compared by their number and two checksums.
    """
    # A cell of two documents had its only pair tested. Members without a count are known to their block only.
    several = members.filter("held IS NULL OR held > 2")
    placed = several.join(parts, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    placed = stored(placed, "placed")
    sums = [F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")]
    cells = placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("held"), *sums
    )
    wanted = cells.filter("low < high AND held > 2").groupBy("held", "x", "y").agg(F.min("key").alias("key"))
    return placed.join(stored(wanted.select("key", "held"), "open"), "key")


def dealt(members: DataFrame, sets: DataFrame, payload: str) -> DataFrame:
    """Members of cells, dealt to pairs of blocks and sorted by pair: key, low, high, inside, own, id, component, payload.

    Members of one component need not meet. So the members of a cell's largest component are cut into blocks of their
    own, which never face each other, and the rest into others, which face all. While the rest is one block, each
    member of the largest component goes to one pair only. A block of the rest meets itself in its pair with the first
    block of the largest, where ``inside`` is set. Blocks are bounded by members and by the bytes of their sets. Ids are
    dealt first, so that the payload of ``sets`` moves once.
    """
    weight = F.greatest(F.lit(BLOCK_BYTES // CELL_BLOCK), F.col("n") * 8)
    part = members.groupBy("key", "component").agg(F.sum(weight).alias("bytes"))
    cells = part.groupBy("key").agg(F.max(F.struct("bytes", "component")).alias("main"), F.sum("bytes").alias("bytes"))
    main_bytes = F.col("main.bytes")
    blocks = {"mains": main_bytes, "rest": F.col("bytes") - main_bytes}
    blocks = {name: F.greatest(F.lit(1), F.ceil(size / BLOCK_BYTES)).cast("int") for name, size in blocks.items()}
    cells = cells.select("key", F.col("main.component").alias("main"), *[size.alias(name) for name, size in blocks.items()])
    spread = F.xxhash64("id", F.lit(2))
    is_main = F.col("component") == F.col("main")
    own = F.when(is_main, F.col("rest") + F.pmod(spread, F.col("mains"))).otherwise(F.pmod(spread, F.col("rest")))
    last = F.when(is_main, F.col("rest") - 1).otherwise(F.col("rest") + F.col("mains") - 1)
    cut = members.join(cells, "key").withColumns({"own": own.cast("int"), "last": last})
    faced = F.explode(F.expr("filter(sequence(0, last), x -> x <> own)")).alias("other")
    met = cut.select("key", "id", "component", "own", "rest", faced)
    low, high = F.least("own", "other"), F.greatest("own", "other")
    inside = (F.col("high") == F.col("rest")).alias("inside")
    met = met.withColumns({"low": low, "high": high}).select("key", "low", "high", inside, "own", "id", "component")
    met = met.join(sets.select("id", payload), "id").select(*met.columns, payload)
    order = ["key", "low", "high"]
    return met.repartition(*order).sortWithinPartitions(*order)


class BlockPair:
    """Members of one cell in two of its blocks, with a tree over their points."""

    def __init__(self, rows: list[tuple], points: np.ndarray, sizes: np.ndarray, percent: int) -> None:
        _, (self.low, *_), _, (self.inside, *_), own, ids, parts, _ = zip(*rows)
        self.own, self.ids, self.parts = np.array(own), np.array(ids), np.array(parts)
        self.points, self.sizes, self.percent = points, sizes, percent
        self.tree = CountTree(points, sizes)

    def candidates(self) -> Iterator[tuple[int, np.ndarray]]:
        """Rows of the lower block with the rows of other components that the bound leaves over."""
        for i in np.flatnonzero(self.own == self.low):
            hits = self.tree.search(self.points[i], int(self.sizes[i]), self.percent)
            hits = hits[self.parts[hits] != self.parts[i]]
            apart = self.own[hits] != self.own[i]
            hits = hits[apart | (self.ids[hits] > self.ids[i])] if self.inside else hits[apart]
            if len(hits):
                yield i, hits


def _per_pair(found: DataFrame, columns: str, work) -> DataFrame:
    """``work`` on the rows of each pair of blocks; it returns tuples of ``columns``."""
    schema = to_arrow_schema(_parse_datatype_string(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in text_batches(batches, TEXT_BYTES):
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and row[:3] != rows[0][:3]:
                    out += work(rows)
                    rows = []
                rows.append(row)
            yield made(out)
        if rows:
            yield made(work(rows))

    def made(out: list[tuple]) -> pa.RecordBatch:
        values = zip(*out) if out else [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)

    return found.mapInArrow(run, columns)


def tree_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """What the trees leave over of each cell (``key``): pairs (``a``, ``b``) of members of different components.

    Where a pair of blocks would give more than ``PAIRS_PER_MEMBER`` pairs for each of its rows, its members that have
    a partner are named once instead (``b`` NULL), so the rows do not grow with the square of a group.
    ``members`` has key, id, component and n.
    """

    def work(rows: list[tuple]) -> list[tuple]:
        if len({row[6] for row in rows}) < 2:
            return []
        points = points_of([row[7] for row in rows])
        pair = BlockPair(rows, points, points.sum(axis=1, dtype=np.int64), percent)
        key, most = rows[0][0], PAIRS_PER_MEMBER * len(rows)
        met, few, ids = np.zeros(len(rows), bool), [], pair.ids
        for i, hits in pair.candidates():
            met[i] = met[hits] = True
            if len(few) <= most:
                few += [(key, int(ids[i]), int(ids[h])) for h in hits]
        return few if len(few) <= most else [(key, int(i), None) for i in ids[met]]

    return _per_pair(dealt(members, sets, "counts"), "key bigint, a bigint, b bigint", work)


def crowds(members: DataFrame) -> DataFrame:
    """``id`` and a new ``key``: cells (``key``, ``id``) that share members become one.

    Near copies of a long text meet in hundreds of cells; joined, each of their sets is sent once and not once a cell.
    """
    first = members.groupBy("key").agg(F.min("id").alias("first"))
    joined = components(members.join(first, "key"), "id", "first")
    ids = members.select("id").distinct().join(joined, "id", "left")
    return ids.select("id", F.coalesce("component", "id").alias("key"))


def tree_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (``a``, ``b``) that join components inside a cell, verified where the trees leave a pair over.

    ``members`` has key, id, component and n. Components that a link has joined count as one from then on, so
    a pair of blocks gives fewer links than it has components, however many of its documents are alike.
    """

    def work(rows: list[tuple]) -> list[tuple]:
        if len({row[6] for row in rows}) < 2:
            return []
        sets = [np.frombuffer(row[7], U64) for row in rows]
        sizes = np.array([len(s) for s in sets])
        pair = BlockPair(rows, points_of([counts(s).tobytes() for s in sets]), sizes, percent)
        # Shingles by their number in this pair of blocks: an intersection is then a look-up in a mask.
        names, numbers = np.unique(np.concatenate(sets), return_inverse=True)
        numbers = np.split(numbers, np.cumsum(sizes)[:-1])
        mask, out = np.zeros(len(names), bool), []
        for i, hits in pair.candidates():
            mask[numbers[i]] = True
            starts = np.concatenate([[0], np.cumsum(sizes[hits])[:-1]])
            both = np.add.reduceat(mask[np.concatenate([numbers[h] for h in hits])], starts, dtype=np.int64)
            mask[numbers[i]] = False
            for h in hits[both >= needed(sizes[i], sizes[hits], percent)]:
                if pair.parts[h] != pair.parts[i]:
                    out.append((int(pair.ids[i]), int(pair.ids[h])))
                    pair.parts[pair.parts == pair.parts[h]] = pair.parts[i]
        return out

    return _per_pair(dealt(members, sets, "shingles"), "a bigint, b bigint", work)


def chosen_rows(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the wanted ids; up to ``BROADCAST_IDS`` of these are sent to the texts, more are joined by a shuffle."""
    few = wanted.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(wanted) if few else wanted, "id").select("id", "text")


def differing(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs whose documents are in different components so far, with the component of ``a``."""
    for side in ("a", "b"):
        named = parts.select(F.col("id").alias(side), F.col("component").alias(f"{side}_part"))
        pairs = pairs.join(named, side, "left")
    part = {side: F.coalesce(f"{side}_part", side) for side in ("a", "b")}
    return pairs.filter(part["a"] != part["b"]).select("a", "b", part["a"].alias("a_part"))


def shared_cells(found: DataFrame) -> DataFrame:
    """Members (key, id, leader, held) of the cells that several documents are in, from ``cell_rows``."""
    # A cell has at most one row per block of the scan here; its smallest document leads it.
    cell = F.expr("struct(min(id) OVER (PARTITION BY key) AS leader, sum(members) OVER (PARTITION BY key) AS held)")
    led = found.filter("kind = 1").select("key", "id", cell.alias("cell"))
    shared = led.filter("cell.held > 1").select("key", "id", "cell.leader", "cell.held")
    others = found.filter("kind = 2").select("key", "id", "leader", F.lit(None).cast("bigint").alias("held"))
    return shared.union(others)


def linked_parts(members: DataFrame, listed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``id`` and ``component`` of every document with a link; all rounds. The result reads nothing of ``sets``."""
    pairs = members.filter("id <> leader").select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b"))
    pairs = stored(pairs.distinct(), "pairs")
    # First one pair per document, which settles groups of near copies; then the other leaders of other components.
    first = stored(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first-pairs")
    equal = listed.filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    links = stored(verified(first, sets, percent).union(equal), "links")
    parts = stored(components(links), "components")
    # Of each document's pairs with one other component a single one goes first here too.
    apart = stored(differing(pairs.join(first, ["a", "b"], "left_anti"), parts), "apart")
    second = stored(apart.groupBy("b", "a_part").agg(F.min("a").alias("a")).select("a", "b"), "second-pairs")
    links = links.union(stored(verified(second, sets, percent), "second-links"))
    parts = stored(components(links), "components")
    third = differing(apart.select("a", "b").join(second, ["a", "b"], "left_anti"), parts).select("a", "b")
    links = links.union(stored(verified(third, sets, percent), "third-links"))
    parts = stored(components(links), "components")

    inside = stored(open_cells(members, parts).join(sets.select("id", "n"), "id"), "open-members")
    if not inside.isEmpty():
        left = stored(tree_pairs(inside, sets, percent), "tree-pairs")
        few = left.filter("b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        few = stored(few.join(pairs, ["a", "b"], "left_anti"), "few-pairs")
        links = links.union(stored(verified(few, sets, percent), "few-links"))
        crowd = stored(left.filter("b IS NULL").select("key", F.col("a").alias("id")).distinct(), "crowd-members")
        if not crowd.isEmpty():
            placed = crowds(crowd).join(inside.select("id", "component", "n").distinct(), "id")
            links = links.union(stored(tree_links(stored(placed, "crowds"), sets, percent), "crowd-links"))
        parts = components(links)
    return parts


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: its number of distinct shingles and its component by links.

    Documents are linked when 100 * intersection >= percent * union of their sets of ``words``-word shingles (lower
    case for A-Z, words between white space; a text with fewer words is one shingle). ``component_id`` is the smallest
    id that can be reached. NULL and empty texts have no shingles and no links. Rows with one id are one document with
    several texts. A row without an id is reported with its size and no component. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    # Cells are many times as many as documents; they go when those that hold several documents are told.
    with work_table(cell_rows(rows, words, percent), "llm-cells", "kind") as found:
        found = found.select("kind", "key", "id", "leader", "members")
        listed = stored(found.filter("kind = 0").select("id", F.col("key").alias("n_shingles"), F.col("leader").alias("rep")), "listed")
        members = stored(shared_cells(found), "members")
    with work_table(shingle_sets(chosen_rows(rows, stored(members.select("id").distinct(), "wanted")), words), "llm-sets") as sets:
        parts = linked_parts(members, listed, sets, percent)
    joined = listed.join(parts, "id", "left")
    return joined.select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component", "id").alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows whose id is the smallest of its component, with all columns; rows without an id stay."""
    found = jaccard_components(docs, doc_id=doc_id, **options)
    others = found.filter("component_id <> doc_id").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(others, docs[doc_id].cast("bigint") == others["_id"], "left_anti")


def op3_count_tree_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)
