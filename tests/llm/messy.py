"""Small tables with everything that may go wrong, shared by the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Names the operators use inside; as extra input columns they must not get in the way.
EXTRA = (
    "kept, row, sha, tag, n, key, id, owner, keep_id, a, b, p, x, site, section, evidence, shift, component, task, place, "
    "virtual_slot, size, shard, path, directory, license, host, slots, token, ids, _id, _cleaned, words, label"
).split(", ")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)
PROSE = "The quick brown fox jumps over the lazy dog near the old river bank, and nobody minds it. "
LONG = " ".join(f"word{i % 997}x{i}" for i in range(40_000)) + "."

TEXTS: list[tuple[int | None, str | None]] = [
    (1, "Short one."),
    (2, None),
    (3, ""),
    (4, " \t\r\n\x0b\x0c "),
    (5, PROSE * 3),
    (6, PROSE * 3),
    (6, PROSE * 3),
    (7, (PROSE * 3).upper()),
    (8, LONG),
    (9, "É É é À la carte   no-break \x1c unit \x85 next   line 日本語 🎉 ﬁ ß İ"),
    (10, "<|endoftext|> x <|startoftext|>y<|endoftext|>"),
    (11, "a\n\nb  c\n d \n"),
    (12, "Home | About | News | Contact\n" * 4),
    (13, "don't we'll I'VE x's ''' ... --- !!! ??? #$%&*"),
    (None, "A row without an id, but with some words in it to look at."),
    (None, None),
    (14, "a b c d"),
    (15, "a b c d e"),
    (-3, "negative ids count as ids too, as far as anybody knows about them."),
]


def messy(spark: SparkSession) -> DataFrame:
    rows = [
        (i, t, "en" if k % 3 else None, f"src{k % 2}" if k % 4 else None, None if t is None else len(t), *["clash"] * len(EXTRA))
        for k, (i, t) in enumerate(TEXTS)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def texts_of(docs: DataFrame) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
