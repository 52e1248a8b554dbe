"""Byte-level BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of a word. A proposal is the exact encoding when each two neighbouring tokens are
compatible: merging their joined bytes gives the two tokens back. All neighbouring pairs of a batch of words are checked
at once against tables of known pairs; only pairs never seen are merged to find out, and only words with an incompatible
pair are merged exactly. Decoding gathers the bytes of all ids of a text in one step.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from parcelmart.llm.common import table, text_batches
from parcelmart.llm.tokens import ID_TYPE, WordTokenizer, public_path

# Known pairs kept per Python worker; beyond it they are found again.
PAIRS = 2_000_000
SHIFT = 20
# Letters below this code point are letters to every Unicode version.
LATIN_END = "ɐ"
# In place of a symbol that was merged into the one before it.
GONE = -1
ENCODED = "doc_id bigint, n_tokens bigint, ids binary"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: itself where printable, else the next after 255."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class SpeculativeBpe(WordTokenizer):
    """The word tokenizer with its new words encoded here instead of by the library."""

    def __init__(self, path: str, **options) -> None:
        self.ready = False
        super().__init__(path, **options)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.vocab: dict[str, int] = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        vocab = self.vocab
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        letters = byte_letters()
        self.letters = dict(enumerate(letters))
        self.letter_ids = {c: vocab[c] for c in letters if c in vocab}
        # Longest token by its first two letters bounds the search.
        self.longest: dict[str, int] = {}
        for token in vocab:
            self.longest[token[:2]] = max(self.longest.get(token[:2], 0), len(token))
        self.texts = {i: t for t, i in vocab.items()}
        self._decode_tables({c: b for b, c in enumerate(letters)})
        self.known = np.empty(0, np.int64)
        self.compatible = np.empty(0, bool)
        self.ready = True

    def _decode_tables(self, byte_of: dict[str, int]) -> None:
        size = max([*self.texts, *self.tokenizer.get_added_tokens_decoder()], default=-1) + 1
        parts = [b""] * size
        for i, token in self.texts.items():
            parts[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            parts[i] = token.content.encode()
        self.lengths = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, ids: bytes) -> str:
        """Text of ids, special tokens included; bytes that are no UTF-8 become replacement characters."""
        tokens = np.frombuffer(ids, ID_TYPE)
        lengths = self.lengths[tokens]
        ends = np.cumsum(lengths)
        if not len(ends):
            return ""
        gather = np.repeat(self.starts[tokens] - (ends - lengths), lengths) + np.arange(ends[-1])
        return self.bytes[gather].tobytes().decode("utf-8", "replace")

    def merge(self, piece: str) -> list[int]:
        """Exact encoding of one piece in byte letters: the pair of lowest rank is merged until none is left."""
        symbols = [self.letter_ids[c] for c in piece]
        size, get = len(symbols), self.merges.get
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        # Pairs by rank, then from the left; one whose symbols were merged away meanwhile is passed over.
        queue = [(*found, i, pair) for i, pair in enumerate(zip(symbols, symbols[1:])) if (found := get(pair))]
        heapify(queue)
        while queue:
            _, new, i, pair = heappop(queue)
            right = after[i]
            if right >= size or (symbols[i], symbols[right]) != pair:
                continue
            symbols[i], symbols[right] = new, GONE
            end = after[i] = after[right]
            if end < size:
                before[end] = i
            for left, other in ((before[i], i), (i, end)):
                if left >= 0 and other < size and (found := get((symbols[left], symbols[other]))):
                    heappush(queue, (*found, left, (symbols[left], symbols[other])))
        return [symbol for symbol in symbols if symbol != GONE]

    def propose(self, piece: str) -> list[int]:
        """Greedy longest match."""
        vocab, longest, out, i, n = self.vocab, self.longest, [], 0, len(piece)
        while i < n:
            end = min(n, i + longest.get(piece[i : i + 2], 1))
            while (token := vocab.get(piece[i:end])) is None:
                end -= 1
            out.append(token)
            i = end
        return out

    def pieces(self, word: str) -> list[str]:
        """What the pre-tokenizer makes of a word, in byte letters."""
        body = word[1:] if word[:1] == " " else word
        if body.isalpha() and max(body) < LATIN_END:
            return [word.encode().decode("latin-1").translate(self.letters)]
        return [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(word)]

    def _odd_words(self, text: str) -> list[str]:
        """Pieces of a text with blank lines, tabs or several spaces; the pre-tokenizer cuts none of them again."""
        return [text[start:end] for _, (start, end) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def encode_words(self, words: list[str]) -> list[bytes]:
        if not self.ready:
            return super().encode_words(words)
        cut = [self.pieces(w) for w in words]
        new = list(dict.fromkeys(p for pieces in cut for p in pieces))
        encoded = dict(zip(new, self.encode_pieces(new)))
        return [b"".join(encoded[p] for p in pieces) for pieces in cut]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        proposals = [self.propose(p) for p in pieces]
        sizes = np.fromiter(map(len, proposals), np.int64, len(proposals))
        ids = np.fromiter((i for p in proposals for i in p), np.int64, int(sizes.sum()))
        first = np.zeros(len(ids), bool)
        first[np.cumsum(sizes) - sizes] = True
        # A piece's first token is paired with nothing (0 in the low bits), which checks that it encodes to itself.
        codes = np.where(first, (ids + 1) << SHIFT, (np.concatenate([[0], ids[:-1]]) + 1 << SHIFT) + ids + 1)
        good = self.check(codes)
        failed = np.zeros(len(pieces), bool)
        failed[np.repeat(np.arange(len(pieces)), sizes)[~good]] = True
        return [
            np.array(self.merge(piece) if bad else tokens, ID_TYPE).tobytes()
            for piece, tokens, bad in zip(pieces, proposals, failed.tolist())
        ]

    def check(self, codes: np.ndarray) -> np.ndarray:
        """For each code, whether its two tokens are compatible; unseen pairs are merged once and remembered."""
        wanted = np.unique(codes)
        at = np.searchsorted(self.known, wanted)
        inside = at < len(self.known)
        seen = np.zeros(len(wanted), bool)
        seen[inside] = self.known[at[inside]] == wanted[inside]
        unseen = wanted[~seen]
        if len(unseen):
            if len(self.known) > PAIRS:
                self.known, self.compatible, unseen = np.empty(0, np.int64), np.empty(0, bool), wanted
            result = np.fromiter(map(self.is_compatible, unseen.tolist()), bool, len(unseen))
            known = np.concatenate([self.known, unseen])
            order = np.argsort(known)
            self.known, self.compatible = known[order], np.concatenate([self.compatible, result])[order]
        return self.compatible[np.searchsorted(self.known, codes)]

    def is_compatible(self, code: int) -> bool:
        tokens = [i - 1 for i in (code >> SHIFT, code & (1 << SHIFT) - 1) if i]
        return self.merge("".join(self.texts[i] for i in tokens)) == tokens


@lru_cache(maxsize=2)
def speculative_bpe(path: str) -> SpeculativeBpe:
    return SpeculativeBpe(path)


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


def encode_texts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: number of ids, and the ids as little-endian unsigned 32-bit integers.

    NULL counts as empty, which has no ids. Special tokens' strings in a text become their ids. Other columns are not
    read, and ids of rows are passed on as they are.
    """
    schema = to_arrow_schema(_parse_datatype_string(ENCODED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = speculative_bpe(path)
        for batch in text_batches(batches):
            ids = bpe.encode_all(batch.column(1).to_pylist())
            counts = pa.array([len(x) // ID_TYPE.itemsize for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, pa.array(ids, pa.binary())], schema=schema)

    return _rows(docs, doc_id, text).mapInArrow(run, ENCODED)


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``doc_id`` and ``ids``; NULL ids are decoded as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = speculative_bpe(path)
        for batch in text_batches(batches):
            texts = [bpe.decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def round_trip_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encoding and decoding in one pass, with checksums in place of ids and texts."""
    schema = to_arrow_schema(_parse_datatype_string(DIGESTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = speculative_bpe(path)
        for batch in text_batches(batches):
            encoded = bpe.encode_all(batch.column(1).to_pylist())
            columns = [
                [len(x) // ID_TYPE.itemsize for x in encoded],
                [hashlib.sha256(x).hexdigest() for x in encoded],
                [hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in encoded],
            ]
            arrays = [batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return _rows(docs, doc_id, text).mapInArrow(run, DIGESTS)


def op4_speculative_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"))
