"""The registered queries and the pipeline, the latter against a brute-force version of all its stages."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from parcelmart.llm import queries
from parcelmart.llm.common import running_offsets
from parcelmart.llm.quality_rules import cleaned_text
from parcelmart.llm.tokens import public_path
from tests.conftest import SMALL
from tests.helpers import frame_rows, rows_of
from tests.llm.test_dedup import brute_components, lower
from tests.llm.test_quality import brute_quality


def test_every_operator_is_registered():
    assert [q.split("_")[0] for q in queries.all_queries()] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", queries.check_sql())
def test_against_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = queries.all_queries()[name](spark, SMALL)
    expected = duck.sql(queries.check_sql()[name])
    assert frame_rows(df) == rows_of(expected.columns, expected.fetchall())


@pytest.mark.parametrize("name", ["op1_license_scan", "op2_line_rules", "op5_hierarchical_quality", "op9_virtual_slots"])
def test_one_row_per_document(spark, name):
    rows = queries.all_queries()[name](spark, SMALL)
    ids = pd.read_parquet(f"{SMALL}/documents.parquet").doc_id
    assert sorted(r["doc_id"] for r in rows.select("doc_id").collect()) == sorted(ids)


def test_pipeline_equals_brute_force(spark):
    docs, labels = (pd.read_parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    good = brute_quality(docs, labels)
    docs = docs[docs.doc_id.map(lambda i: good[i][3] >= 0.5)]
    docs = docs.assign(text=docs.text.map(cleaned_text)).dropna(subset="text")
    docs = docs.assign(key=docs.text.map(lower)).sort_values("doc_id").drop_duplicates("key")
    parts = brute_components(list(zip(docs.doc_id, docs.text)), 5, 80)
    docs = docs[docs.doc_id.map(lambda i: parts[i][1] == i)]
    tokenizer = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    sizes = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in zip(docs.doc_id, docs.text)}
    pieces = corpus_pipeline.run(spark, SMALL).toPandas()
    assert pieces.groupby("doc_id").length.sum().to_dict() == sizes
    assert np.all(pieces.groupby("sequence_id").length.sum().sort_index().iloc[:-1] == 2048)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
        assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_running_offsets(spark):
    rows = [(k, (k * 7) % 11) for k in range(0, 20_000, 3)]
    found = dict(map(tuple, running_offsets(spark.createDataFrame(rows, "k long, n long"), "k", "n", "before").collect()))
    before = np.cumsum([n for _, n in rows]) - [n for _, n in rows]
    assert found == dict(zip([k for k, _ in rows], before.tolist()))
