"""Filters that drop facts without a match in a dimension before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of 64 bits in a filter: at least, where the dimension's size is not known, and at most (8 MB).
FEWEST_WORDS, USUAL_WORDS, MOST_WORDS = 1 << 12, 1 << 16, 1 << 20
# Keys per word a filter is made for, which lets one in sixteen others pass; bytes of a dimension row, as a guess.
KEYS_PER_WORD = 4
ROW_BYTES = 100


def filter_words(dimension_bytes: int | None) -> int:
    """Size of the filter for a dimension, in words; a power of two. More keys than it is made for let more facts pass."""
    if dimension_bytes is None:
        return USUAL_WORDS
    wanted = dimension_bytes // (ROW_BYTES * KEYS_PER_WORD)
    return min(MOST_WORDS, max(FEWEST_WORDS, 1 << wanted.bit_length()))


def _place(key: str, words: int) -> Column:
    """The bit of a key among all bits of a filter."""
    return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(64 * words))


def may_match(keys: DataFrame, key: str, words: int = USUAL_WORDS) -> Column:
    """Predicate on a column ``key``: true wherever ``keys`` has its value, and false for nearly all other values.

    Each key sets one bit, told by its hash. The filter is built by one small aggregation when the query runs and goes to
    the tasks as a constant of at most ``MOST_WORDS`` words, whatever the number of keys.
    """
    word, bit = F.shiftright("place", 6).cast("int").alias("word"), F.col("place").bitwiseAND(63).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("bits")
    hashed = keys.select(_place(key, words).alias("place")).select(word, mask)
    every = keys.sparkSession.range(0, words, 1, 1).select(F.col("id").cast("int"), F.lit(0).cast("bigint"))
    merged = hashed.union(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    listed = merged.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
    filled = listed.select(F.transform("words", lambda x: x["bits"])).scalar()
    place = _place(key, words)
    held = F.get(filled, F.shiftright(place, 6).cast("int"))
    return F.getbit(held, place.bitwiseAND(63).cast("int")) == 1
