"""Quality classifier with hierarchical empirical Bayes.

A logistic classifier on plain text counts gives every document its own evidence. Sums of that evidence per site and per
section of a site (a host and a path, or whatever two columns stand for them) give posteriors that shrink towards the level
above: a section with few documents follows its site, a site with few the whole corpus. How strongly is estimated from the
spread between sites and between sections. A document's evidence is then shifted by its section's posterior odds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from parcelmart.llm.common import ROW_BYTES, stored, table, text_batches

# Most labelled rows the classifier is fitted on; the rows with the smallest hashes of their ids.
LABELLED_ROWS = 20_000
THRESHOLD = 0.5
# Bounds of the estimated prior strengths, in documents.
STRENGTH = (5.0, 1e6)
# Most a section's posterior may add to or take from a document's log-odds.
MOST_SHIFT = 1.5
RIDGE = 1.0
# Sections up to this many bytes are broadcast, more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
FEATURES = (
    "words",
    "symbols",
    "shouted",
    "separated",
    "upper",
    "echo",
    "distinct",
    "top_word",
    "word_length",
    "marks",
    "digits",
    "same_lines",
    "line_words",
)
MARKS = ".,;:!?"
NO_SYMBOLS = bytes("#*$%&<>{}[]^~_=+@\\", "ascii")


def digit_count(text: str, raw: bytes) -> int:
    return len(raw) - len(raw.translate(None, b"0123456789")) if len(raw) == len(text) else sum(map(str.isdigit, text))


def text_features(text: str | None) -> list[float]:
    """Fixed-length counts and shares of a text; all zero but the bias for a NULL or empty one."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    letters = sum(map(len, words))
    upper = sum(map(str.isupper, text.split()))
    return [
        math.log1p(n),
        min(2.0, (len(raw) - len(raw.translate(None, NO_SYMBOLS))) / n),
        min(1.0, raw.count(b"!!") / n),
        min(1.0, raw.count(b"|") / n),
        upper / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        len(counts) / n,
        max(counts.values()) / n if n >= 5 else 0.0,
        min(20.0, letters / n),
        min(1.0, sum(map(text.count, MARKS)) / n),
        min(1.0, digit_count(text, raw) / letters),
        1 - len(set(lines)) / len(lines),
        math.log1p(n / len(lines)),
    ]


def features(docs: DataFrame, doc_id: str, text: str, site: str, section: str, keep_rows: bool) -> DataFrame:
    """Id, site, section and features of every row, with the whole row on request."""
    columns = [
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.coalesce(F.col(section).cast("string"), F.lit("")).alias("section"),
    ]
    # A kept row has its text, which is sent once.
    columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row") if keep_rows else F.col(text).cast("string"))
    place = docs.columns.index(text) if keep_rows else None
    rows = docs.select(*columns)
    result = _parse_datatype_string("doc_id bigint, site string, section string, x array<double>")
    if keep_rows:
        result = result.add(rows.schema["row"])
    schema = to_arrow_schema(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, ROW_BYTES):
            texts = batch.column(3) if place is None else batch.column(3).field(place)
            x = pa.array([text_features(t) for t in texts.to_pylist()], schema.field("x").type)
            columns = [*batch.columns[:3], x, *([] if place is None else [batch.column(3)])]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return rows.mapInArrow(run, result)


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights on raw features and bias of a ridge logistic regression (Newton steps on standardised features).

    With one class only, or no rows, the weights are zero and the bias is the smoothed share of that class.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    if len(set(y.tolist())) < 2:
        return np.zeros(len(FEATURES)), float(np.log(share / (1 - share)))
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    ridge = RIDGE * np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ mean)


def fit_classifier(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", bound: int = LABELLED_ROWS):
    """Classifier fitted on at most ``bound`` labelled rows; a row without a label is not used."""
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("label")]
    known = labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
    chosen = known.orderBy(*order).limit(bound)
    sample = rows.join(F.broadcast(chosen), "doc_id").orderBy(*order, "x").limit(bound).select("x", "label").collect()
    x = np.array([r["x"] for r in sample], np.float64).reshape(len(sample), len(FEATURES))
    return fit(x, np.array([r["label"] for r in sample], np.float64))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def strength(mean: float, spread: float) -> float:
    """Prior strength in documents for a mean and a variance between groups (moments of a beta distribution)."""
    return min(STRENGTH[1], max(STRENGTH[0], mean * (1 - mean) / max(spread, 1e-12) - 1))


def posteriors(scored: DataFrame) -> DataFrame:
    """Posterior share of good documents of every (site, section), shrunk to its site, and that to the corpus."""
    sections = stored(scored.groupBy("site", "section").agg(F.sum("p").alias("s"), F.count(F.lit(1)).alias("n")), "sections")
    sites = sections.groupBy("site").agg(F.sum("s").alias("site_s"), F.sum("n").alias("site_n"))

    def between(groups: DataFrame, s: str, n: str) -> list[Column]:
        # Variance between groups, less what chance alone gives groups of their size.
        share = F.sum(s) / F.sum(n)
        rate = F.col(s) / F.col(n)
        seen = F.sum(F.col(n) * rate * rate) / F.sum(n) - share * share
        chance = share * (1 - share) * F.count(F.lit(1)) / F.sum(n)
        return [share.alias("mean"), (seen - chance).alias("spread")]

    whole = sites.agg(*between(sites, "site_s", "site_n")).first()
    inner = sections.agg(between(sections, "s", "n")[1]).first()
    if whole["mean"] is None:  # no rows
        unknown = [F.lit(None).cast("double").alias(c) for c in ("site_posterior", "section_posterior")]
        return sections.select("site", "section", *unknown, F.lit(0.0).alias("shift"))
    mean = min(max(whole["mean"], 1e-6), 1 - 1e-6)
    k_site, k_section = strength(mean, whole["spread"]), strength(mean, inner["spread"])
    site = (k_site * mean + F.col("site_s")) / (k_site + F.col("site_n"))
    section = (k_section * F.col("site_posterior") + F.col("s")) / (k_section + F.col("n"))
    levels = sections.join(sites.withColumn("site_posterior", site), "site").withColumn("section_posterior", section)
    moved = logit(F.least(F.greatest(F.col("section_posterior"), F.lit(1e-6)), F.lit(1 - 1e-6))) - math.log(mean / (1 - mean))
    shift = F.least(F.lit(MOST_SHIFT), F.greatest(F.lit(-MOST_SHIFT), moved))
    return levels.select("site", "section", "site_posterior", "section_posterior", shift.alias("shift"))


def scored(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, site: str, section: str, threshold: float, keep_rows: bool
) -> DataFrame:
    found = stored(features(docs, doc_id, text, site, section, keep_rows=False), "features")
    weights, bias = fit_classifier(found, labels, doc_id)
    evidence = sum((F.col("x")[i] * float(w) for i, w in enumerate(weights)), F.lit(bias))
    judged = lambda rows: rows.withColumn("evidence", evidence).withColumn("p", sigmoid(F.col("evidence"))).drop("x")
    levels = stored(posteriors(judged(found)), "posteriors")
    # Whole rows are not stored beside their features; counting again takes less than a second copy of every text.
    rows = judged(features(docs, doc_id, text, site, section, keep_rows) if keep_rows else found)
    held = F.octet_length("site") + F.octet_length("section") + 64
    small = (levels.agg(F.sum(held).alias("bytes")).first()["bytes"] or 0) <= BROADCAST_BYTES
    joined = rows.join(F.broadcast(levels) if small else levels, ["site", "section"])
    quality = sigmoid(F.col("evidence") + F.col("shift"))
    return joined.withColumn("quality_score", quality).withColumn("kept", quality >= threshold)


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    section: str = "lang",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per input row: the classifier's own probability, the site's and section's posteriors, the final score
    and whether the document stays (score at least ``threshold``).

    A NULL text counts as empty, a NULL site or section as the empty name; ids may be NULL or repeat. Labels may be
    missing: without any (or with one class only) every document gets the same evidence. Other columns are not read.
    """
    found = scored(docs, labels, doc_id, text, site, section, threshold, keep_rows=False)
    return found.select(
        "doc_id", F.col("p").alias("classifier_score"), "site_posterior", "section_posterior", "quality_score", "kept"
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that stay, with all their columns."""
    names = {"doc_id": "doc_id", "text": "text", "site": "source", "section": "lang", "threshold": THRESHOLD, **options}
    found = scored(docs, labels, keep_rows=True, **names)
    return found.filter("kept").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op5_hierarchical_quality(spark, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
