from __future__ import annotations

import random

import pytest

from parcelmart.operators.ranking import global_rank, percent_rank_pct


def brute_ranks(numbers):
    return sorted((v, 1 + sum(w > v for w in numbers)) for v in numbers)


CASES = {
    "ties": [3, 2, 2, 1],
    "one": [7],
    "wide": [random.Random(1).randrange(-(10**12), 10**12) for _ in range(500)],
    "mostly one value": [5] * 300 + list(range(200)),
    "around the upper bits": [2**20 - 1, 2**20, 2**20 + 1, 2**21, 2**21 - 1, 0, -1, -(2**20), -(2**20) - 1],
    "none": [],
}


@pytest.mark.parametrize("case", CASES)
def test_global_rank(spark, case):
    numbers = CASES[case]
    df = spark.createDataFrame([(v,) for v in numbers], "v bigint")
    ranked = global_rank(df, "v", count="n").collect()
    assert sorted((r["v"], r["rank"]) for r in ranked) == brute_ranks(numbers)
    assert {r["n"] for r in ranked} <= {len(numbers)}


def test_percent_rank(spark):
    df = spark.createDataFrame([(3,), (2,), (2,), (1,)], "v bigint")
    got = sorted((r["v"], float(r["p"])) for r in percent_rank_pct(df, "v", "p").collect())
    assert got == [(1, 100.0), (2, 33.33), (2, 33.33), (3, 0.0)]
    single = percent_rank_pct(spark.createDataFrame([(9,)], "v bigint"), "v", "p").first()
    assert float(single["p"]) == 0.0
