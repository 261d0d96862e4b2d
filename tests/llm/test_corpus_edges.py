"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import itertools
import random
import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from rollbook.llm import (
    decontaminate, language_id, license_scan, line_dedup, mixing, near_dups, quality_rules,
    sample, sharding, toxicity, url_filter,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the quick brown fox jumps over one lazy dog and runs far away into the green wood today "


def prose(n, seed=0):
    words = [f"{w}{(i * 7 + seed) % 13}" for i, w in enumerate((PROSE * n).split())]
    return " ".join(words[: 16 * n])


ROWS = [
    (1, prose(3), "en", "a", 1),
    (1, prose(3), "en", "a", 1),  # repeated row
    (2, prose(3), "en", None, 1),  # copy
    (3, None, None, None, None),
    (4, "", "de", "a", 0),
    (5, "  \n\t ", "de", "b", 0),
    (6, "word", "de", "b", 0),
    (None, prose(4, 3), None, "b", 0),
    (None, None, "fr", "c", None),
    (7, "é" * 10 + " \U0001f600 ünïcode", "fr", "c", 0),
    (8, prose(2000, 5), "en", "c", 0),  # long
    (9, "x" * 300_000, "en", "c", 0),  # one long word
    (10, "\n".join([prose(4, 9)] * 3), "en", "a", 0),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, prose(3)), (2, "too short"), (3, None), (None, prose(2)), (4, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


CLASHING = ("n_words", "failed", "row", "key", "node", "score", "size", "shard", "rate", "__n", "items", "start")


def clashing(df):
    """The same rows with extra columns whose names operators use themselves."""
    return df.select("*", *[F.lit("own").alias(c) for c in CLASHING])


def ids(df):
    return sorted((r[0] is None, r[0] or 0) for r in df.select("doc_id").collect())


def test_quality_of_odd_rows(docs, none):
    found = {r["row"]["doc_id"]: r for r in quality_rules.ledger(docs).collect()}
    assert found[3]["n_words"] == found[4]["n_words"] == found[5]["n_words"] == 0
    assert found[9]["word_chars"] == 300_000 and found[9]["n_words"] == 1
    assert found[7]["word_chars"] == 10 + 1 + 7
    assert found[10]["n_dup_lines"] == 2
    assert quality_rules.ledger(none).count() == 0
    kept = quality_rules.filter_documents(clashing(docs))
    assert kept.columns == clashing(docs).columns
    assert ids(kept) == ids(quality_rules.filter_documents(docs))


def test_near_dups_of_odd_rows(spark, docs, none):
    rows = near_dups.verdicts(spark, docs, words=2).collect()
    assert len(rows) == len(ROWS)
    found = {}
    for r in rows:
        found.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert found[1] == [found[1][0]] * 2 and found[1][0][1:] == (1, True)
    assert found[2][0][1:] == (1, False)
    assert found[3] == [(0, 3, True)] and found[4] == [(0, 4, True)] and found[5] == [(0, 5, True)]
    assert found[6] == [(1, 6, True)] and found[9] == [(1, 9, True)]
    assert sorted(found[None])[0] == (0, None, True)
    assert near_dups.verdicts(spark, none).count() == 0
    kept = near_dups.keep_one(spark, clashing(docs))
    assert kept.columns == clashing(docs).columns
    assert kept.count() == len(ROWS) - 1  # the copy goes


def test_near_dups_of_ids_with_a_full_and_an_empty_text(spark):
    base = prose(6).split()
    full = [(i, " ".join([*base[:i], f"other{i}", *base[i + 1 :]])) for i in range(1, 6)]
    empty = [(i, text) for i in range(1, 6) for text in (None, "", " \n")]
    rows = near_dups.verdicts(spark, spark.createDataFrame(full + empty, "doc_id long, text string")).collect()
    assert len(rows) == len(full + empty)
    assert all(r["component_id"] == 1 for r in rows if r["n_shingles"] > 0)
    assert all(r["component_id"] == r["doc_id"] for r in rows if r["n_shingles"] == 0)


def test_decontamination_of_odd_rows(spark, docs, none, benchmark):
    for words in (0, 1_000_000):  # by join, by broadcast
        found = decontaminate.matches(spark, docs, benchmark, "doc_id", broadcast_words=words).collect()
        assert len(found) == len(ROWS)
        hit = {r["row"]["doc_id"] for r in found if r["items"]}
        assert {1, 2} <= hit and not hit & {3, 4, 5, 6, 7, 9}
        assert decontaminate.matches(spark, none, benchmark, broadcast_words=words).count() == 0
        empty = benchmark.limit(0)
        assert decontaminate.clean(spark, docs, empty, broadcast_words=words).count() == len(ROWS)
        kept = decontaminate.clean(spark, clashing(docs), benchmark, broadcast_words=words)
        assert kept.columns == clashing(docs).columns


def test_mixing_of_odd_rows(spark, docs, none):
    rows = mixing.account(spark, docs).collect()
    assert len(rows) == len(ROWS)
    total = sum(r["size"] for r in rows)
    by_source = {r["source"]: r["target"] for r in rows}
    assert sum(by_source.values()) == pytest.approx(total)
    assert all(r["target"] <= 3 * r["source_size"] + 1e-6 and r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.account(spark, none).count() == 0 and mixing.mix(spark, none).count() == 0
    wordless = docs.withColumn("text", F.lit(" "))
    assert {r["taken"] for r in mixing.account(spark, wordless).collect()} == {0}
    mixed = mixing.mix(spark, clashing(docs))
    assert mixed.columns == clashing(docs).columns
    assert mixed.count() == sum(r["copies"] for r in rows)


def test_line_runs_of_odd_rows(spark, docs, none):
    rows = line_dedup.account(spark, docs, least_words=50).collect()
    assert len(rows) == len(ROWS)
    found = {r["doc_id"]: r for r in rows}
    assert found[3]["n_lines"] == 0 and found[4]["n_lines"] == 1 and found[5]["n_lines"] == 2
    assert found[10]["n_removed"] == 2  # of three equal lines of 64 words
    assert found[2]["n_removed"] == 0  # its copy has 48 words
    assert line_dedup.account(spark, none).count() == 0
    out = line_dedup.dedup(spark, clashing(docs), 50)
    assert out.columns == clashing(docs).columns and out.count() == len(ROWS)
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[10] == prose(4, 9) and texts[3] is None and texts[4] == ""


def test_shards_of_odd_rows(spark, docs, none):
    rows = sharding.shard(spark, clashing(docs), "doc_id").collect()
    counts = [sum(r["shard"] == s for r in rows) for s in range(8)]
    assert sum(counts) == len(ROWS) and max(counts) - min(counts) <= 1
    assert {r["size"] for r in rows if r["row"]["doc_id"] in (3, 4)} == {1}
    assert sharding.shard(spark, none).count() == 0
    few = sharding.shard(spark, docs.limit(3)).collect()
    assert len({r["shard"] for r in few}) == 3 and {r["slot"] for r in few} == {0}


def test_languages_of_odd_rows(spark, docs, none):
    model = language_id.fit(spark, docs, F.lit(True))
    rows = language_id.predict(clashing(docs), model, "doc_id").collect()
    assert len(rows) == len(ROWS)
    found = {r["doc_id"]: r for r in rows}
    for odd in (3, 4, 5):
        assert (found[odd]["lang_pred"], found[odd]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert found[8]["lang_pred"] == "en"
    empty = language_id.fit(spark, none, F.lit(True))
    assert {r["lang_pred"] for r in language_id.predict(docs, empty, "doc_id").collect()} == {"und"}
    assert language_id.predict(none, model, "doc_id").count() == 0
    one = language_id.fit(spark, docs.filter("lang = 'en'"), F.lit(True))
    assert {r["lang_pred"] for r in language_id.predict(docs, one, "doc_id").collect()} == {"en", "und"}


def test_toxicity_of_odd_rows(spark, docs, none):
    labels = spark.createDataFrame(
        [(1, 0), (2, 1), (2, 0), (4, None), (None, 1), (8, 0), (99, 1)], "doc_id long, toxic int"
    )
    weights = toxicity.fit(spark, docs, labels, F.lit(True))
    rows = toxicity.score(clashing(docs), weights, "doc_id").collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.fit(spark, docs, labels.limit(0), F.lit(True)) == []
    assert {r["score"] for r in toxicity.score(docs, [], "doc_id").collect()} == {0.0}
    assert toxicity.score(none, weights, "doc_id").count() == 0
    assert toxicity.fit(spark, none, labels, F.lit(True)) is not None


def learnt_from(spark, monkeypatch, run):
    """The rows of the samples that the learning tasks got."""
    taken = []

    def counting(*args):
        out = sample.bounded(*args)
        taken.append((out.count(), out.agg(F.sum(F.octet_length("text"))).first()[0]))
        return out

    for module in (toxicity, language_id):
        monkeypatch.setattr(module, "bounded", counting)
    run()
    return taken


def test_samples_hold_a_hot_row_once(spark, monkeypatch):
    """One labelled doc_id, one text and the null doc_id stand at a third of the rows each."""
    docs = spark.range(0, 6000, 1, 4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 WHEN id % 3 = 1 THEN NULL ELSE id END AS doc_id",
        "CASE WHEN id % 3 = 0 THEN 'one hot text' ELSE concat('some text of number ', id % 40) END AS text",
        "CASE WHEN id % 2 = 0 THEN 'en' ELSE 'fr' END AS lang",
    )
    labels = docs.filter("doc_id IS NOT NULL").selectExpr("doc_id", "CAST(doc_id < 0 AS INT) AS toxic")
    ran = learnt_from(spark, monkeypatch, lambda: toxicity.fit(spark, docs, labels, F.lit(True)))
    assert ran[0][0] == 1 + 2000
    ran = learnt_from(spark, monkeypatch, lambda: language_id.fit(spark, docs, F.lit(True)))
    assert ran[0][0] == docs.select("lang", "text").distinct().count() < 100


def test_samples_are_bounded_in_rows_and_bytes(spark, monkeypatch):
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "repeat(concat('word', id, ' '), CASE WHEN id = 7 THEN 90000 ELSE 20 END) AS text", "'en' AS lang",
    )
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS toxic")
    for name, value in (("SAMPLE_TOXIC", 50), ("SAMPLE_CLEAN", 60), ("SAMPLE_BYTES", 4000)):
        monkeypatch.setattr(toxicity, name, value)
    for name, value in (("SAMPLE_PER_LANGUAGE", 100), ("SAMPLE_ROWS", 100), ("SAMPLE_BYTES", 8000)):
        monkeypatch.setattr(language_id, name, value)
    ran = learnt_from(spark, monkeypatch, lambda: toxicity.fit(spark, docs, labels, F.lit(True)))
    assert 30 < ran[0][0] <= 110 and ran[0][1] <= 8000
    ran = learnt_from(spark, monkeypatch, lambda: language_id.fit(spark, docs, F.lit(True)))
    assert 30 < ran[0][0] <= 100 and ran[0][1] <= 8000


def test_a_hot_url_does_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "SAMPLE", 20)
    urls = ["http://a.example.net/de/1"] * 3000 + [f"http://h{i}.example.org/fr/{i}" for i in range(30)]
    urls += [f"http://h{i}.example.net/es/{i}" for i in range(30)] + ["https://other.example.org/en/" + "x" * 50_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(4)
    rows = url_filter.judge(spark, pages).collect()
    assert len(rows) == len(urls) and all(r["score"] is not None for r in rows)
    assert {r["verdict"] for r in rows if r["host"].startswith("h") and r["host"].endswith("org")} == {"allow"}


def test_url_trees_learn_from_every_labelled_url(spark, monkeypatch):
    """More different URLs of each label than any sample held; those of one label share their path."""
    pages = spark.range(0, 26_000, 1, 4).selectExpr(
        "id AS page_id",
        "concat('http://h', id, CASE WHEN id >= 25000 THEN '.example.com/es/' WHEN id % 2 = 0 THEN '.net/de/' "
        "ELSE '.org/fr/' END, id % 9) AS url",
    )
    fitted = []
    fit = url_filter.GBTClassifier.fit

    def counting(self, rows):
        fitted.append(rows.groupBy("label").count().collect())
        return fit(self, rows)

    monkeypatch.setattr(url_filter.GBTClassifier, "fit", counting)
    rates = {}
    with_rates = url_filter.with_rates

    def looking(rows, own_rates, own):
        rates.update({name: r.agg(F.sum(f"{name}_n")).first()[0] for name, r in own_rates.items()})
        return with_rates(rows, own_rates, own)

    monkeypatch.setattr(url_filter, "with_rates", looking)
    assert url_filter.judge(spark, pages).filter("verdict IS NULL").count() == 0
    assert sorted(tuple(r) for r in fitted[0]) == [(0.0, 12_500), (1.0, 12_500)]
    assert rates == dict.fromkeys(url_filter.SUFFIXES, 25_000)


def test_licenses_of_odd_rows(spark, docs, none):
    notice = "\nReleased under the MIT License.\n"
    more = [
        (20, PROSE + notice + PROSE, None, None, None),
        (21, "Licensed under CC BY 4.0.\nLicensed under CC BY-NC 4.0.", None, None, None),
        (22, "a license to kill", None, None, None),
        (23, PROSE * 100 + "Released under the MIT License. " + PROSE * 100, None, None, None),
        (24, "This work is licensed under the GNU General Public License, version 4.", None, None, None),
    ]
    every = docs.union(spark.createDataFrame(more, DOCS))
    found = {
        r["doc_id"]: (r["n_blocks"], [f["license"] for f in r["found"]])
        for r in license_scan.scan(clashing(every), "doc_id").collect()
    }
    assert found[20] == (1, ["MIT"]) and found[21] == (1, ["CC-BY-4.0", "CC-BY-NC-4.0"])
    assert found[22] == (1, []) and found[24] == (1, []) and found[3] == (0, [])
    assert found[23][0] == 1
    assert license_scan.scan(none, "doc_id").count() == 0


WRAPPED = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright""",
    "GPL-3.0": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.
""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0""",
}


def test_licenses_in_their_published_wrap(spark):
    forms = [
        lambda t: t, str.upper, lambda t: t.replace("\n", "\n * "), lambda t: PROSE * 40 + t + PROSE * 40,
        lambda t: t.replace(" ", "\n\n\n"), lambda t: t.replace(" ", "   ", 60),
    ]
    names = [(name, f) for name in WRAPPED for f in range(len(forms))]
    rows = [(i, forms[f](WRAPPED[name])) for i, (name, f) in enumerate(names)]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()
    for r in found:
        assert names[r["doc_id"]][0] in [f["license"] for f in r["found"]], names[r["doc_id"]]


def filler(rng, n):
    """Prose with words that licenses use too."""
    parts = ("the", "er", "on", "ti", "license", "of", "any", "use", "copy", "version ")
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_compression_keeps_all_that_the_wording_confirms():
    """All templates in all surroundings: gains choose the same licenses as trying every wording."""
    rng = random.Random(8)
    by_gain = license_scan.Scanner(license_scan.TEMPLATES)
    by_wording = license_scan.Scanner(license_scan.TEMPLATES, -1e9)
    tried = []
    for license_id, texts in license_scan.TEMPLATES.items():
        for text, n in itertools.product(texts, (0, 3, 30, 200)):
            whole = f"{filler(rng, n)} {text} {filler(rng, n)}".encode()
            blocks = license_scan.blocks(whole, by_gain.reach)
            got, want = ({h["license"] for b in blocks for h in s.confirmed(b)} for s in (by_gain, by_wording))
            assert got == want and license_id in got, (license_id, text, n)
            own = license_scan.words(whole.decode())
            tried.append(len(by_gain.winners(own, by_gain.long)) / len(by_gain.long))
    assert sum(tried) < 0.2 * len(tried)  # long texts whose wording is looked at


SHORT_FORMS = {
    "This file is released under the MIT licence.": ["MIT"],
    "Released under the terms of the MIT License.": ["MIT"],
    "SPDX-License-Identifier: MIT": ["MIT"],
    "License: Apache-2.0": ["Apache-2.0"],
    "Creative Commons Attribution 4.0 International License": ["CC-BY-4.0"],
    "Creative Commons Attribution-ShareAlike 4.0 International": ["CC-BY-SA-4.0"],
    "The above copyright notice and this permission notice shall be included in all\ncopies or substantial "
    "portions of the Software.": ["MIT"],
    "Unless required by applicable law or agreed to in writing, software\n# distributed under the License is "
    "distributed on an \"AS IS\" BASIS,\n# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    "\n# See the License for the specific language governing permissions and\n# limitations under the License.":
    ["Apache-2.0"],
    "GNU General Public License, version 3 or GNU Lesser General Public License v3": ["GPL-3.0", "LGPL-3.0"],
    "the GNU General Public License, version 4": [], "under the MIT rules": [], "a licence of sorts": [],
}


def test_short_notices(spark):
    rows = [(i, f"{PROSE * k}\n{form}\n{PROSE * k}") for k in (0, 5) for i, form in enumerate(SHORT_FORMS)]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()
    for r in found:
        want = list(SHORT_FORMS.values())[r["doc_id"]]
        assert [f["license"] for f in r["found"]] == want, list(SHORT_FORMS)[r["doc_id"]]


def test_no_template_is_a_line_of_the_given_documents(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(
        F.explode(F.split("text", "\n")).alias("line")
    ).filter("line ILIKE '%licen%'").distinct().collect()
    given = {tuple(license_scan.words(r["line"])) for r in lines}
    assert given and not given & {tuple(license_scan.words(t)) for texts in license_scan.TEMPLATES.values() for t in texts}


URLS = [
    (1, "http://a.net/x"), (2, "https://WWW.Example.NET/en/1?q=//x"), (3, "http://example.net/de/"),
    (4, "http://x.example.com/de/5#f"), (5, "https://b.org/fr/"), (6, "http://b.org/en/"), (7, None),
    (8, "no scheme"), (9, "http://net"), (10, "http://evilnet/"), (11, ""), (12, "http://?a=b"), (1, "http://a.net/x"),
]


def brute_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].lower(), m[2]) if m else ("", "")
    fits = [
        (len(h + p), h + p, v) for v, h, p in url_filter.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_urls_of_odd_rows(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    rows = url_filter.judge(spark, pages.withColumn("label", F.lit("own"))).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path, rule, verdict = brute_rule(r["row"]["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] in ("block", "allow") and verdict in (None, r["verdict"])
    assert url_filter.judge(spark, pages.limit(0)).count() == 0
    unknown = pages.filter("page_id IN (6, 7)")
    assert {r["verdict"] for r in url_filter.judge(spark, unknown).collect()} == {"allow"}
    assert url_filter.allowed(spark, pages).columns == pages.columns


def test_pipeline_of_odd_rows(spark, docs, none, benchmark, tmp_path):
    for name, table in (("some", docs), ("none", none)):
        folder = str(tmp_path / name)
        table.write.parquet(f"{folder}/documents.parquet")
        benchmark.write.parquet(f"{folder}/benchmark.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert out.columns[:5] == docs.columns
        assert (out.count() > 0) == (name == "some")


def test_pipeline_of_clashing_names(spark, docs, benchmark, tmp_path):
    folder = str(tmp_path)
    own = clashing(docs).withColumn("Curve", F.lit("own")).withColumn("size_", F.lit("own"))
    own.write.parquet(f"{folder}/documents.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == [*own.columns, "size__", "text_crc32", "curve_", "shard_", "slot"]
    rows = out.collect()
    assert rows and {r[c] for r in rows for c in ("size", "shard", "Curve", "size_")} == {"own"}
    assert all(isinstance(r[c], int) for r in rows for c in ("size__", "shard_", "slot"))
