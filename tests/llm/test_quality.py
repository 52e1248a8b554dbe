"""Quality rules, classifier, licences and sharding."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelmart.llm.licenses import LINE_COSINE, TEMPLATES, Matcher, scan_licenses, template_terms
from parcelmart.llm.quality_classifier import classify_quality, fit, keep_good, text_features
from parcelmart.llm.quality_rules import apply_quality_rules, cleaned_text, judge, line_failure, quality_verdicts
from parcelmart.llm.sharding import deal, load_map, rebalance, shard_by_slots
from tests.conftest import SMALL
from tests.llm.messy import LONG, PROSE, TEXTS, empty, messy, texts_of


def brute_counts(text: str | None) -> tuple:
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_counts_equal_brute_force():
    documents = pd.read_parquet(f"{SMALL}/documents.parquet").text
    more = ["a b c d e f", "a b c d e a b c d e", "a a a a a a a", "x y " * 9 + "q", " ".join(map(str, range(7000))) * 2]
    for text in [*documents, *more, *(t for _, t in TEXTS if t != LONG)]:
        assert judge(text)[:6] == brute_counts(text)


def test_lines():
    assert line_failure("Home | About | News | Contact") == "navigation"
    assert line_failure("We use cookies to make this better.") == "boilerplate"
    assert line_failure("so### many*** symbols&&& here%%%") == "symbols"
    assert line_failure("STOP!! IT!! RIGHT!! NOW!!") == "shouting"
    assert line_failure("one one two two three three four four") == "echo"
    assert line_failure("word " * 70) == "repetition"
    for fine in ("", "Yes.", PROSE, "Released under the MIT License.", "Call +1 (499) 555-6503 or mail a.b@example.com today."):
        assert line_failure(fine) is None
    more = " ".join(f"word{i}" for i in range(200)) + "."
    text = f"{PROSE}\nHome | About | News | Contact\n{more}\n\n{PROSE}"
    assert cleaned_text(text) == f"{PROSE}\n{more}\n"


def test_verdicts_and_cleaning(spark):
    docs = messy(spark)
    rows = quality_verdicts(docs).collect()
    assert Counter((r["doc_id"], tuple(r)[1:]) for r in rows) == Counter((i, judge(t)) for i, t in texts_of(docs))
    left = apply_quality_rules(docs, chars="n_chars")
    assert left.columns == docs.columns and left.schema == docs.schema
    assert Counter(texts_of(left)) == Counter((i, cleaned_text(t)) for i, t in texts_of(docs) if judge(t)[6])
    assert left.filter(F.col("n_chars") != F.char_length("text")).count() == 0
    assert quality_verdicts(empty(spark)).count() == apply_quality_rules(empty(spark)).count() == 0


def test_rules_agree_with_labels():
    documents = pd.read_parquet(SMALL.replace("0.001", "0.01") + "/documents.parquet")
    labels = pd.read_parquet(SMALL.replace("0.001", "0.01") + "/labels.parquet")
    merged = documents.merge(labels, on="doc_id")
    verdicts = merged.text.map(judge)
    clean = merged[(merged.quality == 1) & ~verdicts.map(lambda v: v[5])]
    assert verdicts[clean.index].map(lambda v: v[6]).all()
    assert verdicts[merged.quality == 0].map(lambda v: v[6]).mean() < 0.05


def test_classifier_on_held_out_labels():
    folder = SMALL.replace("0.001", "0.1")
    merged = pd.read_parquet(f"{folder}/documents.parquet").merge(pd.read_parquet(f"{folder}/labels.parquet"), on="doc_id").head(1600)
    x, y = np.array([text_features(t) for t in merged.text]), merged.quality.to_numpy(float)
    weights, bias = fit(x[::2], y[::2])
    assert ((x[1::2] @ weights + bias > 0) == y[1::2]).mean() > 0.97


def brute_quality(docs: pd.DataFrame, labels: pd.DataFrame) -> dict:
    """Evidence, posteriors and score of each document, level by level."""
    merged = docs.merge(labels, on="doc_id")
    weights, bias = fit(np.array([text_features(t) for t in merged.text]), merged.quality.to_numpy(float))
    evidence = np.array([text_features(t) for t in docs.text]) @ weights + bias
    frame = docs.assign(e=evidence, p=1 / (1 + np.exp(-evidence)))
    frame[["source", "lang"]] = frame[["source", "lang"]].fillna("")
    mean = frame.p.mean()

    def strength(groups) -> float:
        n, m = groups.p.count(), groups.p.mean()
        spread = (n * m * m).sum() / n.sum() - mean**2 - mean * (1 - mean) * len(n) / n.sum()
        return min(1e6, max(5.0, mean * (1 - mean) / max(spread, 1e-12) - 1))

    site, section = frame.groupby("source"), frame.groupby(["source", "lang"])
    k_site, k_section = strength(site), strength(section)
    top = (k_site * mean + site.p.sum()) / (k_site + site.p.count())
    low = {k: (k_section * top[k[0]] + g.p.sum()) / (k_section + len(g)) for k, g in section}
    logit = lambda v: np.log(v / (1 - v))
    out = {}
    for r in frame.itertuples():
        shift = np.clip(logit(low[r.source, r.lang]) - logit(mean), -1.5, 1.5)
        out[r.doc_id] = (r.p, top[r.source], low[r.source, r.lang], 1 / (1 + np.exp(-(r.e + shift))))
    return out


def test_classifier_levels(spark):
    docs, labels = (pd.read_parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    expected = brute_quality(docs, labels)
    rows = classify_quality(*(spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r)[1:5] == pytest.approx(expected[r["doc_id"]], rel=1e-6)
        assert r["kept"] == (r["quality_score"] >= 0.5)


def test_classifier_on_messy_rows(spark):
    docs, none = messy(spark), spark.createDataFrame([], "doc_id long, quality int")
    labels = spark.createDataFrame([(5, 1), (12, 0), (13, 0), (9, 1), (None, 1), (8, None)], "doc_id long, quality int")
    assert classify_quality(docs, labels).count() == docs.count()
    assert classify_quality(docs, none).select("classifier_score").distinct().count() == 1
    assert keep_good(docs, labels).columns == docs.columns
    assert classify_quality(empty(spark), labels).count() == keep_good(empty(spark), none).count() == 0


def test_licenses(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = [
        (1, "a/LICENSE", mit),
        (2, "a/b/c/code", PROSE),
        (3, "a/b/COPYING", f"{apache}\n"),
        (4, "a/b/c/d/e", None),
        (5, "a/x", f"{PROSE}\n// licensed under CC BY-NC 4.0.\n{PROSE}"),
        (6, "z/y", PROSE),
        (7, None, ""),
        (8, "ab/c", "the license of a dog"),
        (9, "z/q", f"{PROSE * 4} This work is licensed under the GNU General Public License, version 3. {PROSE * 4}"),
        (None, "a/b/c/code", LONG),
        (2, "a/b/c/code", PROSE),
    ]
    frame = spark.createDataFrame([(*f, "clash") for f in files], "doc_id long, path string, text string, license string").repartition(3)
    rows = scan_licenses(frame, F.col("path")).collect()
    assert len(rows) == len(files)
    found = {r["doc_id"]: (r["license"], r["found_in"], r["inherited_from"]) for r in rows}
    assert found == {
        1: ("MIT", "header", None),
        2: ("Apache-2.0", "inherited", "a/b"),
        3: ("Apache-2.0", "header", None),
        4: ("Apache-2.0", "inherited", "a/b"),
        5: ("CC-BY-NC-4.0", "header", None),
        6: (None, "none", None),
        7: (None, "none", None),
        8: (None, "none", None),
        9: ("GPL-3.0", "header", None),
        None: ("Apache-2.0", "inherited", "a/b"),
    }
    assert scan_licenses(frame.limit(0), F.col("path")).count() == 0


def test_sharding(spark, tmp_path):
    docs, path = messy(spark), str(tmp_path / "map")
    rows = shard_by_slots(docs, shards=4, slots=64, map_path=path).collect()
    sizes = lambda t: len(t.encode()) if t else 0
    expected = Counter((i, sizes(t) + 1, zlib.crc32((t or "").encode())) for i, t in texts_of(docs))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    for shard in range(4):
        places = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert places == list(range(len(places)))
    again = {r["doc_id"]: (r["virtual_slot"], r["shard"]) for r in rows}
    grown = shard_by_slots(docs, shards=5, slots=64, map_path=path).collect()
    assert {r["map_version"] for r in grown} == {2} and load_map(spark, path, 1).count() == load_map(spark, path).count()
    assert all(r["virtual_slot"] == again[r["doc_id"]][0] for r in grown)
    assert shard_by_slots(empty(spark)).count() == 0


def test_dealing_and_rebalancing():
    rng = np.random.default_rng(5)
    sizes = {s: int(rng.integers(500, 1500)) for s in range(4096)}
    first = deal(sizes, 16)
    load = lambda m, n: [sum(sizes[s] for s in m if m[s] == k) for k in range(n)]
    assert max(load(first, 16)) - min(load(first, 16)) < 1500
    grown = rebalance(first, sizes, 17)
    moved = [s for s in sizes if grown[s] != first[s]]
    assert max(load(grown, 17)) - min(load(grown, 17)) < 1500 and len(moved) < 4096 / 17 * 1.2
    shrunk = rebalance(grown, sizes, 16)
    assert max(shrunk.values()) == 15 and max(load(shrunk, 16)) - min(load(shrunk, 16)) < 1500
    assert deal({}, 3) == rebalance({}, {}, 3) == {}


def test_digits_of_very_long_texts():
    share = lambda n: text_features("12345 " * n)[10]
    assert share(49_999) == share(50_000) == share(60_000) == 1.0
    assert text_features("é 12 " * 30_000)[10] == pytest.approx(2 / 4)


@pytest.mark.parametrize("n", [10_000, 600_000, 6_000_000])
def test_notice_among_other_words(n):
    known = {"the": 0.9, "under": 0.1, "license": 0.02, "licensed": 0.01, "released": 0.01, "mit": 0.005}
    vocabulary = template_terms(TEMPLATES)
    weights = {t: math.log((n + 1) / (n * known.get(t, 0) + 1)) + 1 for t in vocabulary}
    matcher = Matcher(TEMPLATES, weights, LINE_COSINE)
    for line in (
        "Copyright 2019 Jane Doe. Released under the MIT License.",
        "Released under the MIT License, see there",
        f"{PROSE * 4} Released under the MIT License. {PROSE * 4}",
    ):
        cosine, name = matcher.line(line.lower())
        assert name == "MIT" and cosine == pytest.approx(1.0)


def test_menus_and_bare_lists():
    menu = "Home\nAbout us\n\nContact\nOur shop"
    items = "\n".join(" ".join(f"item{i}{k}" for k in range(3 + i)) for i in range(1, 8))
    flat = "Home About News Contact Shop Login"
    body = "\n".join(" ".join(f"word{i}{k}" for k in range(12)) + "." for i in range(20, 29))
    for junk in (menu, items, flat):
        assert cleaned_text(f"{body}\n{junk}\n{PROSE}").split() == f"{body}\n{PROSE}".split()
    assert judge(f"{menu}\n{items}\n{flat}")[6] is False
    for fine in ("A Heading", "A Heading\nIts Second Line", "You need:\ntwo eggs\nsome flour\nmuch milk"):
        text = f"{body}\n{fine}\n{PROSE}"
        assert cleaned_text(text) == text


def test_kept_rows_are_not_stored_beside_their_features(spark):
    from parcelmart.session import work_dir
    from parcelmart.sources.commits import folders

    before = set(folders(spark, work_dir(spark)))
    docs = spark.createDataFrame([(i, f"s{i % 2}", "en", f"some words of text {i}.", i) for i in range(9)], "doc_id long, source string, lang string, text string, other int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, quality int")
    kept = {tuple(r) for r in keep_good(docs, labels).collect()}
    assert kept <= {tuple(r) for r in docs.collect()}
    good = classify_quality(docs, labels).filter("kept").select("doc_id")
    assert {r[0] for r in kept} == {r[0] for r in good.collect()}
    for name in set(folders(spark, work_dir(spark))) - before:
        assert "row" not in spark.read.parquet(f"{work_dir(spark)}/{name}").columns
