"""Joins, checks, links and manifests on small made tables."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from rollbook.operators import keys, manifest, pages, quality, relate, shape
from rollbook.plans.search import REPORT_COLUMNS, branch_report, branch_search
from rollbook.schema import LINKS, LOAD_ORDER, REGISTRY, code_list
from rollbook.sinks import layout


def test_registry_is_consistent():
    assert sorted(LOAD_ORDER) == sorted(REGISTRY)
    for link in LINKS:
        assert link.column in REGISTRY[link.child].columns
        assert link.key in REGISTRY[link.parent].columns
    assert [len(REGISTRY[t].columns) for t in ("empresa", "estabelecimento", "socios", "simples")] == [
        7, 30, 11, 7
    ]


# -- links --------------------------------------------------------------------------

HTML = """<!-- <a href="no.zip">x</a> --><A class=x HREF='b.zip'>b</A><article href="no.zip">
<script>var s='<a href="no.zip">'</script><a data-href="no.zip" href="a.zip?x=1&amp;y=2">a</a>
<a title="t" href=c.zip>c</a><a href="b.zip">again</a><a name="n">none</a><a href="D.ZIP">d</a>"""


def test_hrefs(spark):
    df = spark.createDataFrame([(1, HTML)], "id int, html string")
    got = df.select(pages.hrefs(F.col("html")).alias("h")).first()["h"]
    assert got == ["b.zip", "a.zip?x=1&y=2", "c.zip", "b.zip", "D.ZIP"]
    kept = pages.extract_links(df, ".zip", "html", "id").collect()
    assert [(r["position"], r["href"]) for r in kept] == [(0, "b.zip"), (2, "c.zip"), (3, "b.zip")]


BASES = ["http://h.org/a/b/c.html?q=1#f", "https://h.org/a/b/", "http://h.org", "http://h.org/x?y=/z"]
HREFS = ["x.zip", "/x.zip", "../x.zip", "./x", "../../x/./y", "http://o.net/z", "//o.net/z", "?p=2",
         "#top", "", "x/../y", "..", "../../../x", "mailto:a@b", "x?a=/../b", "d/", "."]


def test_resolve_matches_the_standard_library(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(pairs, "b string, h string")
    got = [r[0] for r in df.select(pages.resolve(F.col("b"), F.col("h"))).collect()]
    assert dict(zip(pairs, got)) == {p: urljoin(*p) for p in pairs}


# -- manifest -------------------------------------------------------------------------

def test_manifest(spark):
    remote = spark.createDataFrame(
        [("new", 1, True), ("grown", 5, True), ("same", 3, True), ("nosize", None, True),
         ("nosize0", None, True), ("dead", 3, False), ("same", 3, True)],
        "name string, size long, readable boolean",
    )
    local = spark.createDataFrame(
        [("grown", 4), ("same", 3), ("nosize", 9), ("nosize0", 0), ("dead", 3), ("old", 1)],
        "name string, size long",
    )
    got = sorted((r["name"], r["status"]) for r in manifest.diff(remote, local).collect())
    assert got == [("dead", "changed"), ("grown", "changed"), ("new", "new"), ("nosize", "changed"),
                   ("nosize0", "unchanged"), ("same", "unchanged"), ("same", "unchanged")]
    assert {r["name"] for r in manifest.to_load(remote, local).collect()} == {
        "dead", "grown", "new", "nosize"
    }
    assert manifest.diff(remote.drop("readable"), local).filter("name = 'dead'").first()["status"] == (
        "unchanged"
    )


# -- checks ---------------------------------------------------------------------------

def test_key_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    got = {(r["k"], r["n"]) for r in quality.key_violations(df, "k").collect()}
    assert got == {(1, 2), (None, 1)}


def test_orphans_fold_the_child_and_skip_nulls(spark):
    child = spark.createDataFrame([("05",), ("05",), ("9",), ("x",), (None,)], "c string")
    parent = spark.createDataFrame([(5,), (6,)], "k int")
    got = {(r["c"], r["n"]) for r in quality.orphans(child, "c", parent, "k").collect()}
    assert got == {("9", 1), ("x", 1)}


def test_quarantine(spark):
    codes = code_list("pais", "PAIS")
    raw = spark.createDataFrame(
        [("01", "ok"), ("x", "no key"), ("3000000000", "big"), ("2", "n" * 256), ("3", "é" * 255)],
        "codigo string, nome string",
    )
    checked = shape.typed_with_reasons(raw, codes)
    good, bad = checked.filter("NOT rejected"), checked.filter("rejected")
    assert good.count() + bad.count() == raw.count()
    assert sorted(r["codigo"] for r in good.collect()) == [1, 3]
    assert {r["raw"]["codigo"]: r["reasons"] for r in bad.collect()} == {
        "x": ["codigo:null_key"], "3000000000": ["codigo:int_range"], "2": ["nome:length"]
    }
    report = {(r["status"], r["reason"]): r["n"] for r in quality.quarantine_report(checked).collect()}
    assert report[("accepted", None)] == 2 and len(report) == 4


# -- joins ------------------------------------------------------------------------------

@pytest.fixture()
def facts(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k int, x string")
    many = spark.createDataFrame([(1, 10), (1, 11), (3, 30), (4, 40), (None, 0)], "k int, y int")
    return one, many


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_fan_out_is_a_left_join(facts):
    one, many = facts
    want = as_set(one.join(many, "k", "left"))
    assert as_set(relate.fan_out(one, many, "k")) == want
    assert as_set(relate.fan_out(one, many, "k", split_hot=True)) == want


def test_having(facts):
    one, many = facts
    assert as_set(relate.having(one, many, "k")) == [(1, "a"), (3, "c")]


def test_decode_in_two_roles(spark):
    fact = spark.createDataFrame([(1, "02"), (2, "7"), (9, None)], "a int, b string")
    quals = spark.createDataFrame([(1, "um"), (2, "dois")], "codigo int, nome string")
    got = relate.decode(relate.decode(fact, quals, "a", "nome_a"), quals, "b", "nome_b")
    assert as_set(got) == sorted(
        [(1, "02", "um", "dois"), (2, "7", "dois", None), (9, None, None, None)], key=repr
    )


def test_small_sides_are_checked(spark, plan, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    size = relate.plan_bytes(df)
    assert size and size < relate.BROADCAST_BYTES
    fact = spark.range(10).withColumnRenamed("id", "f")
    assert "BroadcastHashJoin" in plan(fact.join(relate.small_side(df, size), F.col("f") == df.id))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = plan(fact.join(relate.small_side(df, size - 1), F.col("f") == df.id))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in big


def test_hot_key_join_is_split(spark, plan, tmp_path):
    """A key with a third of the rows, on the side a plain left join cannot split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    spark.range(0, 300_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "uuid() AS y"
    ).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    one = spark.range(0, 1000, 1, 4).withColumnRenamed("id", "k").withColumn("x", F.lit("x"))
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = relate.fan_out(one, many, "k", split_hot=True).groupBy("k").agg(F.count("y").alias("n"))
        got = {r["k"]: r["n"] for r in joined.collect()}
        final = plan(joined)
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert "skew=true" in final
    want = {k: 0 for k in range(1000)} | {k: 1 for k in range(1000) if k % 3}
    assert got == want | {7: 100_001}


# -- the search -----------------------------------------------------------------------------

@pytest.fixture()
def registry(spark):
    branch = REGISTRY["estabelecimento"].schema
    names = ["Condomínio X", "CONDOMINIO X", "Edificio Y", "Residencial Z", "ACME", None, "Edificio W",
             "Residencial far"]
    keys = ["1", "2", "1", "3", "1", "1", "none", "3"]
    city = [10, 10, 10, 10, 10, 10, 10, 20]
    rows = [
        dict.fromkeys(branch.names) | {"cnpj_basico": k, "nome_fantasia": n, "municipio": m,
                                       "cep": "0612200" + str(i)}
        for i, (k, n, m) in enumerate(zip(keys, names, city))
    ]
    branches = spark.createDataFrame([tuple(r[c] for c in branch.names) for r in rows], branch)
    companies = spark.createDataFrame(
        [(str(k), f"Firma {k}", 5) for k in (1, 2, 3)],
        "cnpj_basico string, razao_social string, porte_empresa int",
    )
    cities = spark.createDataFrame([(10, "OSASCO"), (20, "SANTOS")], "codigo int, nome string")
    return branches, companies, cities


def test_branch_search(registry):
    got = sorted(r[0] for r in branch_search(*registry).collect())
    assert got == ["1", "1", "3"]
    assert sorted(r[0] for r in branch_search(*registry, ci_ai=True).collect()) == ["1", "1", "2", "3"]


def test_branch_report(registry):
    got = branch_report(*registry, postcode="06122002")
    assert got.columns == [*REPORT_COLUMNS, "nome_municipio"]
    assert [(r["razao_social"], r["nome_municipio"]) for r in got.collect()] == [("Firma 1", "OSASCO")]


# -- keys of parts, listed codes --------------------------------------------------------------

def test_key_filters_let_all_known_keys_through(spark):
    stored = spark.range(0, 5000).selectExpr("CASE WHEN id % 500 = 0 THEN NULL ELSE id * 7 END AS k")
    new = spark.range(0, 40_000).selectExpr("id AS k", "'x' AS other")
    for bits in (1 << 15, 1 << 18):
        through = keys.let_through(new, "k", keys.key_filter(stored, "k", bits), bits)
        assert through.columns == ["k", "other"]
        want = {r["k"] for r in stored.collect()} - {None}
        got = {r["k"] for r in through.collect()}
        assert {k for k in want if k < 40_000} <= got and len(got) < 40_000 * (0.2 if bits > 1 << 15 else 0.3)
    shared = keys.shared_keys(new, stored, "k", 1 << 15)
    assert sorted(r["k"] for r in shared.collect()) == sorted(k for k in want if k < 40_000)
    assert keys.shared_keys(new, stored.limit(0), "k").count() == 0
    texts = new.selectExpr("CAST(k AS STRING) AS k")
    assert keys.shared_keys(texts, texts.filter("k LIKE '%77%'"), "k").count() == texts.filter("k LIKE '%77%'").count()


def test_key_filters_are_broadcast_and_bounded(spark, plan):
    stored, new = spark.range(0, 300_000).toDF("k"), spark.range(200_000, 500_000).toDF("k")
    built = keys.key_filter(stored, "k")
    assert built.count() <= keys.BITS // (1 << 15)
    assert "BroadcastHashJoin" in plan(keys.let_through(new, "k", built))


def test_listed_codes_are_decoded_in_order(spark):
    rows = [(1, "2,1,2"), (2, "0001, 9 ,x"), (3, ""), (4, " , ,"), (5, None), (6, "2,1,2"), (7, "3000000000")]
    fact = spark.createDataFrame(rows, "id int, codes string")
    codes = spark.createDataFrame([(1, "one"), (2, "two"), (None, "none")], "codigo int, nome string")
    got = {r["id"]: r["names"] for r in relate.decode_list(fact, codes, "codes", "names").collect()}
    assert got == {1: ["two", "one", "two"], 2: ["one", None, None], 3: [], 4: [], 5: None, 6: ["two", "one", "two"],
                   7: [None]}
    none = relate.decode_list(fact.limit(0), codes, "codes", "names")
    assert none.count() == 0 and none.columns == ["id", "codes", "names"]


def test_declared_links_know_listed_codes(spark):
    cnae = spark.createDataFrame([(1, "one"), (2, "two")], "codigo int, nome string")
    branches = spark.createDataFrame([("a", 1, "2,7,7"), ("b", 5, None)],
                                     "cnpj_basico string, cnae_fiscal_principal int, cnae_fiscal_secundaria string")
    tables = {"estabelecimento": branches, "cnae": cnae}
    got = relate.decode_all(tables, "estabelecimento").collect()
    assert sorted((r["cnae_fiscal_principal_nome"] or "", r["cnae_fiscal_secundaria_nome"]) for r in got) == [
        ("", None), ("one", ["two", None, None])]
    lost = {r["link"]: (r["n_keys"], r["n_rows"]) for r in quality.check_links(tables).collect()}
    assert lost["estabelecimento.cnae_fiscal_secundaria"] == (1, 2)
    assert lost["estabelecimento.cnae_fiscal_principal"] == (1, 1)


def test_a_selection_filters_large_facts_before_their_shuffle(spark, plan, tmp_path):
    spark.range(0, 200_000, 1, 4).selectExpr("CAST(id AS STRING) AS k", "id AS x").write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    found = spark.range(0, 200_000, 1000).selectExpr("CAST(id AS STRING) AS k", "id AS y")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, filtered = relate.join_selected(found, facts, "k"), relate.join_selected(found, facts, "k", 0)
        assert "bitmap" not in plan(plain)
        text = plan(filtered)
        assert "BroadcastHashJoin" in text and "bitmap" in text and "SortMergeJoin" in text
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, filtered.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = keys.let_through(facts, "k", keys.key_filter(found, "k")).count()
    assert 200 <= moved < 400  # of 200,000 rows


def test_a_list_that_is_large_in_memory_is_not_broadcast(spark, tmp_path, plan):
    """Its files are small; the statistics that are taken with it tell rows and widths."""
    wide = spark.range(60_000).selectExpr("CAST(id AS INT) AS codigo", "repeat('texto ', 40) AS nome")
    narrow = spark.range(1000).selectExpr("CAST(id AS INT) AS codigo", "CAST(id AS STRING) AS nome")
    fact = spark.range(1000).selectExpr("CAST(id AS INT) AS c")
    try:
        for name, rows in (("wide_list", wide), ("narrow_list", narrow)):
            layout.keep_snapshot(rows, name, str(tmp_path / name), "2025-10", analyze=["codigo", "nome"])
        files = spark.read.parquet(str(tmp_path / "wide_list"))
        assert relate.plan_bytes(files) < relate.BROADCAST_BYTES < relate.plan_bytes(spark.table("wide_list"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for name, hint in (("wide_list", False), ("narrow_list", True)):
            decoded = relate.decode(fact, spark.table(name), "c", "n")
            assert ("BroadcastHashJoin" in plan(decoded)) == hint
            assert decoded.filter("n IS NOT NULL").count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("wide_list", "narrow_list"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
