"""Exact duplicates by owners in Patricia tries.

Texts are dealt out by length and content hash, and each part inserts the full byte strings into compressed radix tries:
an edge holds the bytes shared by all strings below it, a terminal node the owner of its string and a count. The same
tries first run over blocks of each input task, so a text that is very common reaches the shuffle once per block. When the
tries of a task outgrow their budget, the largest subtrees are emitted and dropped ("spilled"); what is emitted twice
for one text is merged in the last, fixed-size aggregation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from parcelmart.llm.common import ROW_BYTES, stored, table, text_batches

# Bytes of text and nodes a task's tries may hold, and what a node counts for.
TRIE_BYTES = 32 << 20
BLOCK_BYTES = 32 << 20
NODE_BYTES = 300
# Parts of one length: bits of the content hash.
BUCKET_BITS = 16
# Rows that leave are told by a broadcast of their tags up to this many (16 MB), and by a shuffle beyond.
BROADCAST_TAGS = 1_000_000
PREPARED = (
    "doc_id bigint, tag bigint, sha string, length int, bucket int, text string, owner bigint, owner_tag bigint, n bigint"
)
OWNERS = "sha string, owner bigint, owner_tag bigint, n bigint"


class Node:
    """Edge label into the node, children by their first byte, and the payload of a string that ends here."""

    __slots__ = ("label", "children", "payload")

    def __init__(self, label: bytes, payload: list | None = None) -> None:
        self.label = label
        self.children: dict[int, Node] = {}
        self.payload = payload


def shared_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A compressed radix trie from byte strings to payloads."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.bytes = 0

    def find_or_add(self, key: bytes) -> tuple[list, bool]:
        """Payload of ``key`` (a list the caller fills) and whether it is new."""
        node, at = self.root, 0
        while True:
            if at == len(key):
                new = node.payload is None
                if new:
                    node.payload = []
                return node.payload, new
            child = node.children.get(key[at])
            if child is None:
                leaf = Node(key[at:], [])
                node.children[key[at]] = leaf
                self.bytes += len(leaf.label) + NODE_BYTES
                return leaf.payload, True
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            same = shared_prefix(child.label, key[at : at + len(child.label)])
            middle = Node(child.label[:same])
            child.label = child.label[same:]
            middle.children[child.label[0]] = child
            node.children[key[at]] = middle
            self.bytes += NODE_BYTES
            node, at = middle, at + same

    def spill(self) -> Iterator[list]:
        """Payloads of the largest subtree below the first branching, which leaves the trie."""
        parent, node = None, self.root
        while node.payload is None and len(node.children) == 1:
            parent, node = node, next(iter(node.children.values()))
        if node.children and node.payload is None:
            parent, node = node, max(node.children.values(), key=weight)
        if parent is None:
            parent, node = None, self.root
        self.bytes -= weight(node)
        yield from payloads(node)
        if parent is None:
            self.root, self.bytes = Node(b""), 0
        else:
            del parent.children[node.label[0]]


def nodes(node: Node) -> Iterator[Node]:
    todo = [node]
    while todo:
        node = todo.pop()
        todo += node.children.values()
        yield node


def weight(node: Node) -> int:
    return sum(len(n.label) + NODE_BYTES for n in nodes(node))


def payloads(node: Node) -> Iterator[list]:
    return (n.payload for n in nodes(node) if n.payload)


class TrieForest:
    """Tries by (length, bucket), with the owner and the number of rows of each text; ``sign`` 1 keeps the largest id."""

    def __init__(self, sign: int, budget: int = TRIE_BYTES) -> None:
        self.sign, self.budget = sign, budget
        self.tries: dict[tuple[int, int], Trie] = {}
        self.bytes = 0

    def add(self, key: tuple[int, int], text: bytes, owner: int | None, tag: int, n: int, note) -> None:
        trie = self.tries.get(key)
        if trie is None:
            trie = self.tries[key] = Trie()
        held = trie.bytes
        payload, new = trie.find_or_add(text)
        self.bytes += trie.bytes - held
        if new:
            payload += [owner, tag, n, note]
            return
        payload[2] += n
        if self.rank(owner, tag) > self.rank(payload[0], payload[1]):
            payload[0], payload[1], payload[3] = owner, tag, note

    def rank(self, owner: int | None, tag: int) -> tuple:
        """NULL ids own a text only if no other row has it."""
        return (owner is not None, self.sign * (owner or 0), tag)

    def overflow(self) -> Iterator[list]:
        """Payloads of subtrees that have to go to keep the budget."""
        while self.bytes > self.budget and self.tries:
            key = max(self.tries, key=lambda k: self.tries[k].bytes)
            trie = self.tries[key]
            self.bytes -= trie.bytes
            yield from trie.spill()
            self.bytes += trie.bytes
            if not trie.bytes:
                del self.tries[key]

    def drain(self) -> Iterator[list]:
        for trie in self.tries.values():
            yield from payloads(trie.root)
        self.tries, self.bytes = {}, 0


def normalised(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case and nothing else changed."""
    return (text or "").encode().lower()


def place(key: bytes) -> tuple[int, int]:
    """Length and bucket of the content hash."""
    import xxhash

    return len(key), xxhash.xxh3_64_intdigest(key) & ((1 << BUCKET_BITS) - 1)


def prepared(docs: DataFrame, sign: int, doc_id: str, text: str, keep_rows: bool) -> DataFrame:
    """Every row with its tag and hash; the owner within its block carries the text and the block's count.

    With ``keep_rows`` the other columns of the input row go along in ``row``; the text itself is sent once.
    """
    columns = [F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")]
    if keep_rows:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"))
    rows = docs.select(*columns)
    ddl = _parse_datatype_string(PREPARED)
    if keep_rows:
        ddl = ddl.add(rows.schema["row"])
    schema = to_arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tag = TaskContext.get().partitionId() << 33
        for batch in text_batches(batches, ROW_BYTES if keep_rows else BLOCK_BYTES):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            forest, keys, places = TrieForest(sign), [], []
            for i, value in enumerate(texts):
                key = normalised(value)
                keys.append(hashlib.sha256(key).hexdigest())
                places.append(place(key))
                forest.add(places[i], key, ids[i], tag + i, 1, i)
            owned = {p[3]: p for p in forest.drain()}
            columns = [
                ids,
                range(tag, tag + len(ids)),
                keys,
                [p[0] for p in places],
                [p[1] for p in places],
                [texts[i] if i in owned else None for i in range(len(ids))],
                *([owned[i][k] if i in owned else None for i in range(len(ids))] for k in range(3)),
            ]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
            if keep_rows:
                arrays.append(batch.column(2))
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)
            tag += len(ids)

    return rows.mapInArrow(run, ddl)


def trie_owners(carriers: DataFrame, sign: int, budget: int = TRIE_BYTES) -> DataFrame:
    """Owner and number of rows of every text, from rows that carry texts; one pass of tries over each part."""
    schema = to_arrow_schema(_parse_datatype_string(OWNERS))

    def emit(found: list[list]) -> pa.RecordBatch:
        columns = ([p[3] for p in found], *([p[k] for p in found] for k in range(3)))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = TrieForest(sign, budget)
        for batch in text_batches(batches, ROW_BYTES):
            for length, bucket, text, sha, owner, tag, n in zip(*(c.to_pylist() for c in batch.columns)):
                forest.add((length, bucket), normalised(text), owner, tag, n, sha)
            if forest.bytes > forest.budget:
                yield emit(list(forest.overflow()))
        yield emit(list(forest.drain()))

    dealt = carriers.repartition("length", "bucket").select("length", "bucket", "text", "sha", "owner", "owner_tag", "n")
    found = dealt.mapInArrow(run, OWNERS)
    known = F.col("owner").isNotNull()
    best = F.max(F.struct(known.alias("known"), (F.col("owner") * sign).alias("by"), "owner_tag", "owner"))
    merged = found.groupBy("sha").agg(best.alias("best"), F.sum("n").alias("group_size"))
    return merged.select("sha", F.col("best.owner").alias("keep_id"), F.col("best.owner_tag").alias("keep_tag"), "group_size")


def with_owners(docs: DataFrame, keep: str, doc_id: str, text: str, keep_rows: bool) -> tuple[DataFrame, DataFrame]:
    """Stored rows with their tags, and the owner of each text."""
    sign = {"largest": 1, "smallest": -1}[keep]
    rows = stored(prepared(docs, sign, doc_id, text, keep_rows), "texts")
    # Stored, so that the join has an exchange of its own on this side and can split the rows of a very common text.
    return rows, stored(trie_owners(rows.filter(F.col("n").isNotNull()), sign), "owners")


def exact_duplicates(docs: DataFrame, keep: str = "smallest", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: which row of its text stays, and how many rows have that text.

    Texts are equal when they are the same after lower-casing A-Z only; NULL counts as empty. The row with the smallest
    (or ``keep="largest"``) id stays, one row only even where an id repeats; a NULL id stays only if all ids of the text
    are NULL. Other columns are not read.
    """
    rows, owners = with_owners(docs, keep, doc_id, text, keep_rows=False)
    found = rows.drop("text").join(owners, "sha").withColumn("kept", F.col("tag") == F.col("keep_tag"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, keep: str = "smallest", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; rules as in ``exact_duplicates``."""
    rows, owners = with_owners(docs, keep, doc_id, text, keep_rows=True)
    # The row that stays owns its text in its block too. Only hashes and tags meet the owners, texts do not move again.
    carriers = rows.filter(F.col("n").isNotNull())
    losers = carriers.select("sha", "tag").join(owners, "sha").filter(F.col("tag") != F.col("keep_tag")).select("tag")
    losers = stored(losers, "losers")
    if losers.count() <= BROADCAST_TAGS:
        losers = F.broadcast(losers)
    whole = F.col("text").cast(docs.schema[text].dataType)
    kept = carriers.join(losers, "tag", "left_anti")
    return kept.select(*[(whole if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])


def op6_trie_owners(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


# Groups the lower-cased texts by value.
OP6_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""
