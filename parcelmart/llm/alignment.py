"""Alignment of two tokenizers over a corpus, with document counts of linked id pairs.

Both tokenizers cut a text before a single space between two other characters, whatever stands around it. So texts are cut
into units there, and each distinct unit of a task is encoded and aligned once; a document is the sum of its units.

Pass one aligns every document once. It keeps a document's numbers, digest and linked ids, and gives, per task, how many
documents hold each pair of ids linked. The distinct pairs get a minimal perfect hash, built per bucket of pairs: levels
of bit arrays, in which a pair that is alone at its place is settled, and the rest go on to the next level. A pair's slot is
the number of bits before its own. Counts are dense vectors indexed by slot, one per bucket and group of tasks, and summed
up in a tree. Pass two looks the kept pairs up and encodes nothing; the pair stored at a slot is compared, so a pair that
was never counted cannot take another's count.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from parcelmart.llm.common import stored, table, text_batches
from parcelmart.llm.tokens import public_path

# A cut: a space between two characters that no tokenizer takes for white space.
UNIT_START = re.compile(r"(?<=\S) (?=\S)")
WHITE = [chr(i) for i in range(0x3001) if chr(i).isspace()]
# Units of one call to the libraries; units, links and characters remembered per worker, emptied beyond.
UNITS_PER_CALL = 4000
CACHE_UNITS, CACHE_LINKS, CACHE_CHARS = 1_000_000, 6_000_000, 64_000_000
BATCH_BYTES = 8 << 20
LINK_BYTES = 4 << 20
# Pairs of a bucket on average, bits per unsettled pair, tasks whose counts make one vector, vectors summed at once.
BUCKET_PAIRS = 16_384
BITS_PER_PAIR = 2
TASKS_PER_VECTOR = 8
FAN_IN = 8
# Pairs whose hash, keys and counts are broadcast at most (about 17 bytes each); beyond, counts are joined.
BROADCAST_PAIRS = 4_000_000
PARTIALS = "task bigint, mixed bigint, pair bigint, n bigint"
BUCKETS = "bucket bigint, n int, sizes array<int>, words binary, keys binary"
VECTORS = "bucket bigint, part bigint, counts binary"
ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
# What pass one keeps of a document, and a document's pairs where they are joined.
KEPT = "uid bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links_a binary, links_b binary"
HELD = "uid bigint, pair bigint, links bigint"


def byte_of_symbol() -> dict[str, int]:
    """Byte-level symbols: printable Latin-1 characters stand for their own byte, the others for those from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def odd_spaces(text: str) -> bool:
    """Whether a space of the text stands at an end or beside other white space."""
    return text[0] == " " or text[-1] == " " or any(w in text and (f"{w} " in text or f" {w}" in text) for w in WHITE)


class Aligned(NamedTuple):
    """Per unit: whether both tokenizers give its bytes, numbers of tokens, groups and links, the groups as text, and the
    links (a << 32 | b) of unit ``i`` at ``starts[i]:starts[i + 1]``."""

    valid: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    texts: list[str]
    starts: np.ndarray
    links: np.ndarray


class Aligner:
    """Both tokenizers of a pair of files: byte-level BPE (A) and pieces with byte fallback (B)."""

    def __init__(self, path_a: str, path_b: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        # Spark gives each worker its core; more threads would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        symbols = byte_of_symbol()
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(symbols[c] for c in e) if all(c in symbols for c in e) else e.encode() for e in entries]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.sizes_a = np.array([len(b) for b in self.bytes_a])
        self.sizes_b = np.array([len(b) for b in self.bytes_b])
        self.names = [str(i) for i in range(max(len(entries), len(pieces)))]
        # Kept links take two bytes an id where the vocabulary allows it.
        self.kinds = np.min_scalar_type(len(entries)).newbyteorder("<"), np.min_scalar_type(len(pieces)).newbyteorder("<")
        # Cutting is right if no piece has its space sign behind another character.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)

    def units(self, text: str) -> list[str]:
        """``text`` with a space before it, cut into units, each without the space it begins with."""
        if not text or not self.cuts:
            return [text] if text else []
        if odd_spaces(text):
            # The space before the text belongs to an odd run where the text begins with white space.
            first, *units = UNIT_START.split(f"x {text}")
            return units if first == "x" else [first[2:], *units]
        return text.split(" ")

    def align(self, units: list[str], with_texts: bool = True) -> Aligned:
        parts = [self._align(units[i : i + UNITS_PER_CALL], with_texts) for i in range(0, len(units), UNITS_PER_CALL)]
        valid, n_a, n_b, n_groups, texts, counts, links = zip(*parts)
        starts = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        joined = [np.concatenate(x) for x in (valid, n_a, n_b, n_groups)]
        return Aligned(*joined, [t for part in texts for t in part], starts, np.concatenate(links))

    def _align(self, units: list[str], with_texts: bool) -> tuple:
        raws = list(map(str.encode, units))
        all_a = [e.ids for e in self.a.encode_batch([f" {u}" for u in units], add_special_tokens=False)]
        all_b = self.b.encode(units, num_threads=1)
        valid = np.ones(len(units), bool)
        sides = (self.bytes_a, self.sizes_a), (self.bytes_b, self.sizes_b)
        if not all(gives(*side, *flattened(ids), raws) for side, ids in zip(sides, (all_a, all_b))):
            each = [[gives(*side, *flattened([x]), [raw]) for x, raw in zip(ids, raws)] for side, ids in zip(sides, (all_a, all_b))]
            valid = np.logical_and(*each)
            all_a, all_b = ([x if ok else [] for x, ok in zip(ids, valid)] for ids in (all_a, all_b))
        (flat_a, n_a), (flat_b, n_b) = flattened(all_a), flattened(all_b)
        a, b = np.array(flat_a, np.int64), np.array(flat_b, np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        starts_a, starts_b = ends_a - self.sizes_a[a], ends_b - self.sizes_b[b]
        # Units end on both sides, so one run over all of them links nothing across two.
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        first, last = np.searchsorted(ends_b, starts_a, "right"), np.searchsorted(starts_b, ends_a, "left")
        width = last - first
        at = np.repeat(first - np.cumsum(width) + width, width) + np.arange(width.sum())
        links = (np.repeat(a, width) << 32) | b[at]
        owner_a = np.repeat(np.arange(len(units)), n_a)
        counts = np.bincount(owner_a, width, len(units)).astype(np.int64)
        last_a, last_b = np.searchsorted(ends_a, shared), np.searchsorted(ends_b, shared)
        n_groups = np.bincount(owner_a[last_a], minlength=len(units))
        if not with_texts:
            return valid, n_a, n_b, n_groups, [], counts, links
        cuts_a, cuts_b = ([0, *(x + 1).tolist()] for x in (last_a, last_b))
        names_a, names_b = (list(map(self.names.__getitem__, flat)) for flat in (flat_a, flat_b))
        groups = [
            f"{','.join(names_a[i:j])}|{','.join(names_b[k:m])}"
            for i, j, k, m in zip(cuts_a, cuts_a[1:], cuts_b, cuts_b[1:])
        ]
        cut = np.concatenate([[0], np.cumsum(n_groups)]).tolist()
        texts = [";".join(groups[i:j]) for i, j in zip(cut, cut[1:])]
        return valid, n_a, n_b, n_groups, texts, counts, links


def flattened(ids: list[list[int]]) -> tuple[list[int], np.ndarray]:
    """All ids in a row, and how many each unit has."""
    return list(chain.from_iterable(ids)), np.fromiter(map(len, ids), np.int64, len(ids))


def gives(entries: list[bytes], sizes: np.ndarray, flat: list[int], n: np.ndarray, raws: list[bytes]) -> bool:
    """Whether the ids of each unit stand for a space and its bytes: all of them joined, with an end where each unit ends."""
    if b"".join(map(entries.__getitem__, flat)) != b" " + b" ".join(raws):
        return False
    ends = np.concatenate([[0], np.cumsum(sizes[flat])]) if flat else np.zeros(1, np.int64)
    return bool((ends[np.cumsum(n)] == np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)) + 1)).all())


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


class Units:
    """The distinct units met so far with what a document's numbers are added up from."""

    def __init__(self, found: Aligner, with_texts: bool = True) -> None:
        self.aligner, self.with_texts = found, with_texts
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[str] = []
        self.chars = 0
        self.numbers = np.zeros((6, 0), np.int64)  # valid, tokens of A, of B, groups, links; starts of the links
        self.pairs = np.zeros(0, np.int64)  # numbers in ``names`` of the linked pairs
        self.names: dict[int, int] = {}

    def full(self) -> bool:
        return len(self.index) > CACHE_UNITS or len(self.pairs) > CACHE_LINKS or self.chars > CACHE_CHARS

    def add(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Documents and units, one entry per unit of a text, after learning what is new."""
        lists = [self.aligner.units(t or "") for t in texts]
        sizes = [len(units) for units in lists]
        met = [u for units in lists for u in units]
        found = list(map(self.index.get, met))
        new = list(dict.fromkeys([u for u, i in zip(met, found) if i is None]))
        if new:
            got = self.aligner.align(new, self.with_texts)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.texts += got.texts
            self.chars += sum(map(len, new)) + sum(map(len, got.texts))
            counts = np.diff(got.starts)
            rows = np.stack([got.valid, got.n_a, got.n_b, got.n_groups, counts, got.starts[:-1] + len(self.pairs)])
            self.numbers = np.concatenate([self.numbers, rows], axis=1)
            links, local = np.unique(got.links, return_inverse=True)
            numbers = np.array([self.names.setdefault(x, len(self.names)) for x in links.tolist()], np.int64)
            self.pairs = np.concatenate([self.pairs, numbers[local] if len(links) else numbers])
            found = [self.index[u] if i is None else i for u, i in zip(met, found)]
        return np.repeat(np.arange(len(lists)), sizes), np.array(found, np.int64)

    def totals(self, docs: np.ndarray, flat: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
        """Per document whether it has tokens, and the sums over its units."""
        has = np.bincount(docs, minlength=n_docs) > 0
        has &= np.bincount(docs, self.numbers[0][flat] == 0, n_docs) == 0
        return has, np.stack([np.bincount(docs, c[flat], n_docs).astype(np.int64) * has for c in self.numbers[1:5]])

    def links_of(self, flat: np.ndarray) -> np.ndarray:
        """The linked pairs of units, in their order and as often as they occur."""
        return self._names()[self.pairs[self._places(flat)]]

    def documents_with(self, docs: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs and how many of the documents hold each."""
        both = distinct(docs * len(self.index) + flat)
        found = distinct(self._linked(both // len(self.index), both % len(self.index)) if len(both) else both)
        count = np.bincount(found % max(1, len(self.names)), minlength=len(self.names))
        met = np.flatnonzero(count)
        return self._names()[met], count[met]

    def _names(self) -> np.ndarray:
        return np.fromiter(self.names, np.int64, len(self.names))

    def _places(self, flat: np.ndarray) -> np.ndarray:
        """Where in ``pairs`` the links of units are."""
        width, start = self.numbers[4][flat], self.numbers[5][flat]
        return np.repeat(start - np.cumsum(width) + width, width) + np.arange(width.sum())

    def _linked(self, docs: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """Document and pair of every link, as one number."""
        return np.repeat(docs, self.numbers[4][flat]) * max(1, len(self.names)) + self.pairs[self._places(flat)]


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values in order; for many whole numbers a sort is faster than a hash."""
    values = np.sort(values)
    return values[np.concatenate([values[:1] == values[:1], values[1:] != values[:-1]])]


def mix(values: np.ndarray) -> np.ndarray:
    """64-bit integers well mixed, one to one."""
    x = values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def place_in_level(mixed: np.ndarray, level: int, size) -> np.ndarray:
    return mix(mixed + np.uint64(level + 1)) % np.asarray(size, np.uint64)


def build_hash(pairs: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Minimal perfect hash of distinct pairs: bits of each level, the bits of all levels as 64-bit words, and the pairs by slot."""
    sizes, words, by_slot, left = [], [], [], pairs
    while len(left):
        level, size = len(sizes), -(-BITS_PER_PAIR * len(left) // 64) * 64
        place = place_in_level(mix(left), level, size)
        alone = np.bincount(place.astype(np.int64), minlength=size)[place] == 1
        bits = np.zeros(size, np.uint8)
        bits[place[alone]] = 1
        words.append(np.packbits(bits, bitorder="little").view("<u8"))
        by_slot.append(left[alone][np.argsort(place[alone])])
        sizes.append(size)
        left = left[~alone]
    empty = np.zeros(0, np.int64)
    return sizes, np.concatenate(words or [empty.astype("<u8")]), np.concatenate(by_slot or [empty])


class PerfectHash:
    """Slots of pairs over buckets numbered from 0, each with its own levels."""

    def __init__(self, sizes: list, words: list[np.ndarray]) -> None:
        depth = max(map(len, sizes), default=0)
        self.sizes = np.zeros((len(sizes), depth), np.int64)
        for i, s in enumerate(sizes):
            self.sizes[i, : len(s)] = s
        self.words = np.concatenate([*words, np.zeros(1, "<u8")])
        ends = np.cumsum(self.sizes.ravel()).reshape(self.sizes.shape)
        self.first = ends - self.sizes
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])

    def slots(self, pairs: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Slot of each pair, counted over all buckets; -1 where no level has its bit."""
        found, open_, mixed = np.full(len(pairs), -1, np.int64), np.arange(len(pairs)), mix(pairs)
        for level in range(self.sizes.shape[1]):
            size = self.sizes[buckets[open_], level]
            open_, size = open_[size > 0], size[size > 0]
            place = place_in_level(mixed[open_], level, size).astype(np.int64) + self.first[buckets[open_], level]
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            found[open_[hit]] = (self.before[place >> 6] + below)[hit]
            open_ = open_[~hit]
        return found


class PairCounts:
    """Counts of pairs by slot, and whether a pair has the highest count of its A id."""

    def __init__(self, rows: list, buckets: int) -> None:
        rows, self.buckets = sorted(rows, key=lambda r: r["bucket"]), buckets
        by_bucket = {r["bucket"]: r for r in rows}
        every = [by_bucket.get(i) for i in range(buckets)]
        self.hash = PerfectHash([r["sizes"] if r else [] for r in every], [np.frombuffer(r["words"], "<u8") for r in rows])
        self.keys = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(r["keys"], "<i8") for r in rows]])
        self.counts = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(r["counts"], "<i8") for r in rows]])
        top = np.zeros(int(self.keys.max(initial=0) >> 32) + 1, np.int64)
        np.maximum.at(top, self.keys >> 32, self.counts)
        self.best = self.counts == top[self.keys >> 32]

    def find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each pair and whether it is its A id's best; a pair whose key is not at its slot counts 0."""
        if not len(self.keys) or not len(pairs):
            return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        slot = self.hash.slots(pairs, bucket_of(pairs, self.buckets))
        same = (slot >= 0) & (self.keys[slot] == pairs)
        return np.where(same, self.counts[slot], 0), (same & self.best[slot]).astype(np.int64)


def bucket_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(pairs) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def binaries(values: np.ndarray, n: np.ndarray) -> pa.Array:
    """``values`` cut into binary values of ``n`` items each."""
    ends = np.concatenate([[0], np.cumsum(n) * values.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(values)])


def kept_links(batch: pa.RecordBatch) -> np.ndarray:
    """The linked pairs of all documents of a batch, from what ``binaries`` made of their ids."""
    links = max(1, batch.column("n_links").to_numpy().sum())
    raws = (b"".join(batch.column(f"links_{side}").to_pylist()) for side in "ab")
    a, b = (np.frombuffer(raw, f"<u{len(raw) // links or 1}") for raw in raws)
    return a.astype(np.int64) << 32 | b


def first_pass(docs: DataFrame, path_a: str, path_b: str, text: str, doc_id: str | None = None, with_groups: bool = False) -> DataFrame:
    """Rows of one or two kinds: how many documents of a scan task hold a pair linked (``pair``; a task's rows may come in
    several parts), and with ``doc_id`` what is kept of each document (``uid``, of which no two rows have the same)."""
    kept = [c.split()[0] for c in KEPT.split(", ")] + ["groups"] * with_groups if doc_id else []
    ddl = PARTIALS + (f", {KEPT}" if doc_id else "") + (", groups string" if doc_id and with_groups else "")
    schema = to_arrow_schema(_parse_datatype_string(ddl))

    def filled(columns: dict, n: int) -> pa.RecordBatch:
        arrays = [columns.get(f.name, pa.nulls(n, f.type)) for f in schema]
        arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(arrays, schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, found = TaskContext.get().partitionId(), aligner(path_a, path_b)
        units, uid = Units(found, with_texts=bool(kept)), task << 33
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            names, inverse = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return names, np.bincount(inverse, np.concatenate([h[1] for h in held]), len(names)).astype(np.int64)

        def emit(pairs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            mixed = (mix(pairs) >> np.uint64(33)).astype(np.int64)
            return filled({"task": np.full(len(pairs), task), "mixed": mixed, "pair": pairs, "n": counts}, len(pairs))

        def documents(batch: pa.RecordBatch, at: np.ndarray, flat: np.ndarray, has: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            cut = np.searchsorted(at, np.arange(batch.num_rows + 1)).tolist()
            texts, names = units.texts, flat.tolist()
            groups = [";".join([texts[u] for u in names[i:j]]) if ok else "" for ok, i, j in zip(has, cut, cut[1:])]
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            links = units.links_of(flat[has[at]])
            sides = [binaries(ids.astype(kind), sums[3]) for ids, kind in zip((links >> 32, links & 0xFFFFFFFF), found.kinds)]
            columns = [uid + np.arange(batch.num_rows), batch.column(1), *sums, digests, *sides, groups]
            return filled(dict(zip(kept, columns)), batch.num_rows)

        for batch in text_batches(batches, BATCH_BYTES):
            if units.full():
                units.clear()
            at, flat = units.add(batch.column(0).to_pylist())
            has, sums = units.totals(at, flat, batch.num_rows)
            keep = has[at]
            held.append(units.documents_with(at[keep], flat[keep]))
            if kept:
                yield documents(batch, at, flat, has, sums)
                uid += batch.num_rows
            if sum(len(h[0]) for h in held) > CACHE_LINKS:
                held = [merged()]
                if len(held[0][0]) > CACHE_LINKS // 2:
                    yield emit(*held[0])
                    held = []
        if held:
            yield emit(*merged())

    columns = [F.col(text).cast("string").alias("text")]
    columns += [F.col(doc_id).cast("bigint").alias("doc_id")] if doc_id else []
    return docs.select(*columns).mapInArrow(run, ddl)


def hash_buckets(partials: DataFrame, buckets: int) -> DataFrame:
    """The minimal perfect hash of all pairs, one row per bucket: bits of its levels, words, and pairs by slot."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        sizes, words, keys = build_hash(np.sort(group["pair"].to_numpy(np.int64)))
        row = (int(group["bucket"].iloc[0]), len(keys), sizes, words.tobytes(), keys.astype("<i8").tobytes())
        return pd.DataFrame([row], columns=["bucket", "n", "sizes", "words", "keys"])

    distinct = partials.select((F.col("mixed") % buckets).alias("bucket"), "pair").distinct()
    return distinct.groupBy("bucket").applyInPandas(build, BUCKETS)


def count_vectors(partials: DataFrame, hashed: DataFrame, buckets: int) -> DataFrame:
    """One dense vector of counts per bucket, indexed by slot: a vector per bucket and group of tasks, summed up in a tree."""

    def scatter(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"bucket": [], "part": [], "counts": []}).astype({"bucket": "int64", "part": "int64"})
        own, pairs = found.iloc[0], rows["pair"].to_numpy(np.int64)
        slots = PerfectHash([list(own["sizes"])], [np.frombuffer(own["words"], "<u8")]).slots(pairs, np.zeros(len(pairs), np.int64))
        counts = np.zeros(int(own["n"]), "<i8")
        np.add.at(counts, slots, rows["n"].to_numpy(np.int64))
        return pd.DataFrame([(int(own["bucket"]), int(own["part"]), counts.tobytes())], columns=["bucket", "part", "counts"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, "<i8") for c in group["counts"]).astype("<i8").tobytes()
        row = (int(group["bucket"].iloc[0]), int(group["part"].iloc[0]) // FAN_IN, total)
        return pd.DataFrame([row], columns=["bucket", "part", "counts"])

    part = F.floor(F.col("task") / TASKS_PER_VECTOR).cast("bigint").alias("part")
    rows = partials.select((F.col("mixed") % buckets).alias("bucket"), part, "pair", "n")
    last = rows.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0]
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint"))).alias("part")
    # The hash alone is some 3 bits a pair; the pairs themselves stay where they are.
    sent = hashed.select("bucket", "n", "sizes", "words", every)
    vectors = rows.groupBy("bucket", "part").cogroup(sent.groupBy("bucket", "part")).applyInPandas(scatter, VECTORS)
    while last:
        above = F.floor(F.col("part") / FAN_IN).cast("bigint")
        vectors = vectors.groupBy("bucket", above.alias("above")).applyInPandas(add, VECTORS)
        last //= FAN_IN
    return vectors.select("bucket", "counts")


class PairTable(NamedTuple):
    """Buckets of pairs with hash, keys by slot and counts by slot; their number and that of all pairs."""

    rows: DataFrame
    buckets: int
    pairs: int

    def counts(self) -> DataFrame:
        """One row per pair: its ids, how many documents hold it linked, and whether that is the A id's highest count."""

        def unfold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for keys, counts in zip(frame["keys"], frame["counts"]):
                    yield pd.DataFrame({"pair": np.frombuffer(keys, "<i8"), "n": np.frombuffer(counts, "<i8")})

        pairs = self.rows.select("keys", "counts").mapInPandas(unfold, "pair bigint, n bigint")
        a, b = F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")
        pairs = pairs.select("pair", a, b, "n")
        top = pairs.groupBy("a").agg(F.max("n").alias("top"))  # at most one row per id of A
        return pairs.join(F.broadcast(top), "a").select("pair", "a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def pair_table(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> PairTable:
    """The counts of all linked pairs of the corpus."""
    return counted(stored(first_pass(docs, path_a, path_b, text), "pair-partials"))


def counted(partials: DataFrame) -> PairTable:
    n = partials.select("pair").distinct().count()
    buckets = -(-n // BUCKET_PAIRS) or 1
    hashed = stored(hash_buckets(partials, buckets), "pair-hash")
    vectors = stored(count_vectors(partials, hashed, buckets), "pair-counts")
    return PairTable(hashed.join(vectors, "bucket"), buckets, n)


def looked_up(aligned: DataFrame, pairs: PairTable, columns: list[str], ddl: str) -> DataFrame:
    """Pass two with the hash at hand: counts of the kept links, summed up per document."""
    # Bounded by broadcast_pairs.
    counts = aligned.sparkSession.sparkContext.broadcast(PairCounts(pairs.rows.collect(), pairs.buckets))
    schema = to_arrow_schema(_parse_datatype_string(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, LINK_BYTES):
            n, best = counts.value.find(kept_links(batch))
            ends = np.concatenate([[0], np.cumsum(batch.column("n_links").to_numpy())])
            sums = {name: np.diff(np.concatenate([[0], np.cumsum(x)])[ends]) for name, x in (("n_best", best), ("count_sum", n))}
            arrays = [pa.array(sums[c]) if c in sums else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(arrays, schema)], schema=schema)

    return aligned.drop("uid").mapInArrow(run, ddl)


def joined_counts(aligned: DataFrame, pairs: PairTable, columns: list[str]) -> DataFrame:
    """Pass two by a join with the list of pairs, whatever their number."""
    schema = to_arrow_schema(_parse_datatype_string(HELD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, LINK_BYTES):
            names, number = np.unique(kept_links(batch), return_inverse=True)
            docs = np.repeat(np.arange(batch.num_rows), batch.column("n_links").to_numpy())
            keys, links = np.unique(docs * max(1, len(names)) + number, return_counts=True)
            uids = batch.column("uid").to_numpy()[keys // max(1, len(names))]
            found = [uids, names[keys % max(1, len(names))], links]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, schema)], schema=schema)

    held = aligned.select("uid", "n_links", "links_a", "links_b").mapInArrow(run, HELD)
    joined = held.join(stored(pairs.counts(), "pair-list").select("pair", "n", "best"), "pair")
    found = joined.groupBy("uid").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("_best"), F.sum(F.col("links") * F.col("n")).alias("_sum")
    )
    out = aligned.drop("links_a", "links_b").join(found, "uid", "left")
    zero = F.lit(0).cast("bigint")
    return out.withColumns({"n_best": F.coalesce("_best", zero), "count_sum": F.coalesce("_sum", zero)}).select(*columns)


def align_documents(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    doc_id: str = "doc_id",
    text: str = "text",
    with_groups: bool = False,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """One row per document: numbers of tokens, groups and links, of links with their A id's best count, and the sum of
    the links' counts. ``groups_sha256`` is the digest of the groups, which ``with_groups`` adds as text (``groups``).

    A text that is NULL or empty, or that one of the tokenizers does not give back byte by byte, has no tokens: numbers
    0, digest and groups ''. Rows are never merged: repeated rows and NULL ids count as documents of their own. Other
    columns are not read. Pairs beyond ``broadcast_pairs`` are looked up by a join with the same results.
    """
    found = stored(first_pass(docs, path_a, path_b, text, doc_id, with_groups), "aligned")
    aligned = found.filter("uid IS NOT NULL").drop("task", "mixed", "pair", "n")
    pairs = counted(found.filter("pair IS NOT NULL").select("task", "mixed", "pair", "n"))
    ddl = ALIGNED + (", groups string" if with_groups else "")
    columns = [c.split()[0] for c in ddl.split(", ")]
    if pairs.pairs > broadcast_pairs:
        return joined_counts(aligned, pairs, columns)
    return looked_up(aligned, pairs, columns, ddl)


def op11_pair_alignment(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return align_documents(docs, public_path("byte_bpe_50k.json"), public_path("piece_bpe_32k.model"))
