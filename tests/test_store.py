"""Sinks, layouts, the snapshot load and its streaming twin."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from rollbook import session as ses
from rollbook.operators.relate import join_facts
from rollbook.operators.shape import typed_with_reasons
from rollbook.plans import check_files, check_store, load, publish  # noqa: F401 - registers
from rollbook.plans.registered import QUERIES
from rollbook.schema import REGISTRY
from rollbook.sinks import layout, tables
from rollbook.streaming import files as stream

SIMPLES = REGISTRY["simples"]


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(("\n".join(lines) + "\n").encode("latin-1"))


def raw_month(root, extra=()):
    write(root / "K1.SIMPLES.CSV", ['"1";"S";"20070701";"00000000";"N";"";""',
                                    '"2";"SIM";"20070701";"";"N";"";""', *extra])
    write(root / "Y.PAISCSV", ['"013";"AFEGANISTAO"', '"";"SEM CODIGO"'])
    write(root / "Y.MOTICSV", ['"00";"SEM MOTIVO"'])
    write(root / "Y.EMPRECSV", [])
    (root / "Y.EMPRECSV").write_bytes(b"")
    write(root / "notes.txt", ["nothing"])


def test_load_twice_and_next_month(spark, tmp_path):
    raw_month(tmp_path / "raw")
    out = str(tmp_path / "out")
    want = {"pais": (1, 1), "moti": (1, 0), "empresa": (0, 0), "simples": (1, 1)}
    for _ in range(2):
        assert load.load_snapshot(spark, str(tmp_path / "raw"), out, "2025-10") == want
    raw_month(tmp_path / "raw2", extra=['"3";"N";"";"";"N";"";""'])
    load.load_snapshot(spark, str(tmp_path / "raw2"), out, "2025-11")
    good = load.read_table(spark, out, SIMPLES)
    assert sorted((r["cnpj_basico"], r["snapshot"]) for r in good.collect()) == [
        ("1", "2025-10"), ("1", "2025-11"), ("3", "2025-11")
    ]
    bad = load.read_rejects(spark, out, SIMPLES, "2025-10").collect()
    assert [(r["raw"]["opcao_simples"], r["reasons"]) for r in bad] == [("SIM", ["opcao_simples:length"])]
    # keep-and-append, as the other setting of the switch
    load.load_snapshot(spark, str(tmp_path / "raw"), out, "2025-10", keep_existing=True)
    assert load.read_table(spark, out, SIMPLES, "2025-10").count() == 2


def test_zipped_files_are_routed_by_member_name(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw / "F.PAISCSV", ['"013";"AFEGANISTAO"'])
    with zipfile.ZipFile(raw / "Naturezas.zip", "w") as z:
        z.writestr("F.K1.NATJUCSV", b'"2062";"Sociedade"\n"x";"sem"\n')
        z.writestr("sub/F.K1.QUALSCSV", b'"49";"S\xf3cio"\n')
        z.writestr("LEIAME", b"nothing")
    with zipfile.ZipFile(raw / "Paises.zip", "w") as z:
        z.writestr("F.K1.PAISCSV", b'"105";"BRASIL"\n')
    counts = load.load_snapshot(spark, str(raw), str(tmp_path / "o"), "2025-10")
    assert counts == {"pais": (2, 0), "quals": (1, 0), "natju": (1, 1)}
    quals = load.read_table(spark, str(tmp_path / "o"), REGISTRY["quals"])
    assert [tuple(r) for r in quals.collect()] == [(49, "Sócio", "2025-10")]


def test_a_reload_without_rows_empties_the_snapshot(spark, tmp_path):
    raw_month(tmp_path / "raw")
    out = str(tmp_path / "out")
    for month in ("2025-10", "2025-11"):
        load.load_snapshot(spark, str(tmp_path / "raw"), out, month)
    write(tmp_path / "raw" / "K1.SIMPLES.CSV", ["", ""])
    counts = load.load_snapshot(spark, str(tmp_path / "raw"), out, "2025-10")
    assert counts["simples"] == (0, 0)
    left = load.read_table(spark, out, SIMPLES).collect()
    assert [r["snapshot"] for r in left] == ["2025-11"]
    assert load.read_rejects(spark, out, SIMPLES, "2025-10").count() == 0


def test_no_rows_give_an_empty_typed_table(spark, tmp_path):
    empty = spark.createDataFrame([], load.stored_schema(SIMPLES))
    tables.replace_snapshot(empty, str(tmp_path / "t" / "simples"), "2025-10")
    got = load.read_table(spark, str(tmp_path / "t"), SIMPLES)
    assert got.count() == 0
    assert [f.dataType for f in got.schema.fields][:-1] == [f.dataType for f in SIMPLES.schema.fields]


def test_snapshot_choice_prunes(spark, tmp_path, plan):
    path = str(tmp_path / "s")
    df = spark.range(100).selectExpr("id", "concat('2025-0', 1 + id % 3) AS snapshot")
    for _ in range(2):
        tables.write_snapshots(df, path)
    one = tables.read_snapshots(spark, path, df.drop("snapshot").schema, "2025-02")
    assert one.count() == 33
    assert "PartitionFilters: [((snapshot" in plan(one)


def test_create_table(spark):
    tables.create_table(spark, SIMPLES, "simples_t")
    spark.sql("INSERT INTO simples_t VALUES ('1','S',date'2020-01-01',null,'N',null,null)")
    tables.create_table(spark, SIMPLES, "simples_t", recreate=False)
    assert spark.table("simples_t").count() == 1
    tables.create_table(spark, SIMPLES, "simples_t")
    assert spark.table("simples_t").count() == 0
    assert spark.table("simples_t").schema == SIMPLES.schema
    spark.sql("DROP TABLE simples_t")


def test_bucketed_join_needs_no_shuffle(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(2000).selectExpr("cast(id % 500 as string) AS k", "id AS x")
        right = spark.range(500).selectExpr("cast(id as string) AS k", "id AS y")
        assert layout.bucket(left, "b_left", "k", 4) and layout.bucket(right, "b_right", "k", 4)
        joined = join_facts(spark.table("b_left"), spark.table("b_right"), "k")
        assert "Exchange" not in plan(joined)
        assert joined.count() == 2000
        assert len(spark.table("b_left").inputFiles()) == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for t in ("b_left", "b_right"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_hot_key_is_not_bucketed(spark):
    hot = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id as string) END k", "id")
    try:
        assert not layout.bucket(hot, "b_hot", "k", 4)
        assert spark.table("b_hot").count() == 3000
    finally:
        spark.sql("DROP TABLE IF EXISTS b_hot")


def test_clustered_lookup(spark, tmp_path, plan):
    df = spark.range(10_000).selectExpr("id", "concat('S', id % 3) AS uf", "id % 97 AS municipio")
    path = str(tmp_path / "c")
    layout.cluster(df, path, ["municipio"], ["uf"], bloom=["municipio"])
    found = spark.read.parquet(path).filter("uf = 'S1' AND municipio = 5")
    assert found.count() == df.filter("uf = 'S1' AND municipio = 5").count() > 0
    text = plan(found)
    assert "PartitionFilters: [isnotnull(uf" in text and "EqualTo(municipio,5)" in text


def test_a_hot_value_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(0, 200_000, 1, 8).selectExpr(
        "uuid() AS id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('v', id % 50) END AS uf"
    )
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "300KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "50KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        layout.cluster(df, str(tmp_path / "h"), ["uf"])
    finally:
        for k in settings:
            spark.conf.unset(k)
    back = spark.read.parquet(str(tmp_path / "h")).filter("uf = 'hot'")
    assert back.count() == 66_667
    assert back.select("_metadata.file_path").distinct().count() > 3


def test_stream_equals_batch(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    first = ['"1";"S";"20070701";"00000000";"N";"";""', '"2";"SIM";"";"";"a\nb";"";""']
    write(folder / "one.csv", first)
    run = lambda: stream.load_new(
        spark, SIMPLES, str(folder), out, str(tmp_path / "cp"), "2025-10"
    )
    run()
    run()
    write(folder / "two.csv", ['"3";"N";"";"";"N";"";"20200101"'])
    run()
    whole = str(tmp_path / "whole")
    load.load_table(spark, SIMPLES, load.Inputs([str(folder)]), whole, "2025-10")
    key = lambda df: sorted((tuple(r) for r in df.drop("snapshot").collect()), key=repr)
    for read in (load.read_table, load.read_rejects):
        assert key(read(spark, out, SIMPLES, "2025-10")) == key(read(spark, whole, SIMPLES, "2025-10"))
    assert load.read_table(spark, out, SIMPLES, "2025-10").count() == 2
    assert load.read_table(spark, out, SIMPLES, "2025-11").count() == 0


def test_streamed_and_appended_keys_are_unique(spark, tmp_path):
    cities, raw, out = REGISTRY["munic"], tmp_path / "in", str(tmp_path / "out")
    run = lambda: {
        r["file"].rsplit("/", 1)[1]: (r["accepted"], r["rejected"]) for r in
        stream.load_new(spark, cities, str(raw), out, str(tmp_path / "cp"), "2025-10").collect()
    }
    write(raw / "one.csv", ['"013";"A"', '"7";"SEVEN"', '"";"none"'])
    assert run() == {"one.csv": (2, 1)}
    write(raw / "two.csv", ['"13";"B"', '"8";"EIGHT"', '"008";"AGAIN"'])
    assert run() == {"one.csv": (2, 1), "two.csv": (1, 2)}
    # the second batch once more, as after a failure: its own rows are no reason to reject it
    again = load.load_table(spark, cities, load.Inputs([str(raw / "two.csv")]), out, "2025-10.000001", month="2025-10")
    assert again == (1, 2)
    kept = load.read_table(spark, out, cities, "2025-10").collect()
    assert sorted((r["codigo"], r["nome"]) for r in kept) == [(7, "SEVEN"), (8, "AGAIN"), (13, "A")]
    bad = load.read_rejects(spark, out, cities, "2025-10").collect()
    assert sorted((r["raw"]["codigo"] or "", r["reasons"][0]) for r in bad) == [
        ("", "codigo:null_key"), ("13", "codigo:duplicate_key"), ("8", "codigo:duplicate_key")]
    appended = str(tmp_path / "appended")
    for name, want in (("one.csv", (2, 1)), ("two.csv", (1, 2)), ("two.csv", (0, 3))):
        inputs = load.Inputs([str(raw / name)])
        assert load.load_table(spark, cities, inputs, appended, "2025-10", keep_existing=True) == want
    stored = load.read_table(spark, appended, cities, "2025-10")
    assert sorted(r["codigo"] for r in stored.collect()) == [7, 8, 13]
    assert spark.read.parquet(f"{appended}/munic").filter("NOT rejected AND raw IS NOT NULL").isEmpty()


def test_rows_without_a_key_are_dealt_over_many_groups(spark, plan):
    raw = spark.range(1000).selectExpr("CAST(NULL AS STRING) AS codigo", "CAST(id AS STRING) AS nome", "'f' AS source_file")
    checked = typed_with_reasons(raw, REGISTRY["munic"], "source_file", unique=True)
    assert checked.filter("rejected").count() == 1000
    assert "Window" in plan(checked) and "xxhash64(" in plan(checked)


def test_odd_inputs_of_a_load(spark, tmp_path):
    """Files without bytes, folders named like tables, keys that repeat."""
    raw, out = tmp_path / "raw", str(tmp_path / "o")
    write(raw / "EMPRESAS" / "K1.SIMPLES.CSV", ['"1";"S";"";"";"N";"";""'])
    write(raw / "K1.PAISCSV", ['"013";"A"', '"13";"B"', '"x";"C"', '"14";"D"', '"13";"A"'])
    assert load.load_snapshot(spark, str(raw), out, "2025-10") == {"pais": (2, 3), "simples": (1, 0)}
    kept = load.read_table(spark, out, REGISTRY["pais"], "2025-10").collect()
    assert sorted((r["codigo"], r["nome"]) for r in kept) == [(13, "A"), (14, "D")]
    why = [r["reasons"] for r in load.read_rejects(spark, out, REGISTRY["pais"], "2025-10").collect()]
    assert sorted(why) == [["codigo:duplicate_key"], ["codigo:duplicate_key"], ["codigo:null_key"]]
    (raw / "EMPRESAS" / "K1.SIMPLES.CSV").write_bytes(b"")
    (raw / "K1.MOTICSV").write_bytes(b"")
    counts = load.load_snapshot(spark, str(raw), out, "2025-10")
    assert counts["simples"] == counts["moti"] == (0, 0)
    assert load.read_table(spark, out, SIMPLES, "2025-10").count() == 0
    assert load.read_table(spark, out, REGISTRY["moti"]).count() == 0


def test_workspace_uses_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = ses.workspace(spark, "x"), ses.workspace(spark, "x")
    assert a != b and a.startswith(root + "/rollbook/x-")


def test_work_folders_are_cleared(spark, monkeypatch):
    monkeypatch.setattr(ses, "_made", {})
    folder = ses.workspace(spark, "gone")
    spark.range(3).write.parquet(f"{folder}/a")
    ses.workspace(spark, "never written")
    assert os.path.isdir(folder) and ses.clear_workspaces(spark) == 2
    assert not os.path.isdir(folder) and ses.clear_workspaces(spark) == 0


class FakeConf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class FakeSpark:
    def __init__(self, **conf):
        self.conf = FakeConf({k.replace("_", "."): v for k, v in conf.items()})


def test_workspace_without_the_setting():
    assert os.path.isdir(ses.workspace(FakeSpark(spark_master="local[2]"), "x").split("/rollbook/")[0])
    with pytest.raises(RuntimeError):
        ses.workspace(FakeSpark(spark_master="spark://host:7077"), "x")


def test_counts_taken_on_the_way_match(spark, tmp_path):
    raw_month(tmp_path / "raw")
    counts = load.load_snapshot(spark, str(tmp_path / "raw"), str(tmp_path / "o"), "2025-10")
    stored = spark.read.parquet(str(tmp_path / "o" / "pais"))
    assert counts["pais"] == (
        stored.filter(~F.col("rejected")).count(), stored.filter("rejected").count()
    )


def test_bucketed_join_needs_no_shuffle(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["q_bucketed_join"](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_a_failed_run_is_repeated(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "o")
    write(raw / "K1.PAISCSV", ['"1";"A"'])
    whole = publish.write_parts
    monkeypatch.setattr(publish, "write_parts", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        publish.load_changed(spark, str(raw), out, "2025-10")
    monkeypatch.setattr(publish, "write_parts", whole)
    assert publish.load_changed(spark, str(raw), out, "2025-10").counts == {"pais": (1, 0)}
    assert publish.load_changed(spark, str(raw), out, "2025-10").counts == {}
    os.remove(raw / "K1.PAISCSV")
    write(raw / "K2.PAISCSV", ['"1";"A"', '"2";"B"'])
    assert publish.load_changed(spark, str(raw), out, "2025-10").counts == {"pais": (2, 0)}
    os.remove(raw / "K2.PAISCSV")
    write(raw / "K2.MOTICSV", ['"1";"A"'])
    counts = publish.load_changed(spark, str(raw), out, "2025-10").counts
    assert counts == {"moti": (1, 0), "pais": (0, 0)}
    assert publish.read_table(spark, out, REGISTRY["pais"], "2025-10").count() == 0


def test_tables_whose_archives_are_gone_or_shrunken_are_emptied(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "o")
    raw.mkdir()

    def pack(name, **members):
        with zipfile.ZipFile(raw / name, "w") as archive:
            for member, text in members.items():
                archive.writestr(member, text)

    def run():
        return publish.load_changed(spark, str(raw), out, "2025-10", database="archives").counts

    def rows(name):
        return publish.read_table(spark, out, REGISTRY[name], "2025-10").count()

    pack("a.zip", K1PAISCSV='"1";"A"\n', K1MOTICSV='"1";"A"\n"2";"B"\n')
    pack("b.zip", K1MUNICCSV='"1";"A"\n')
    assert run() == {"pais": (1, 0), "moti": (2, 0), "munic": (1, 0)}
    pack("a.zip", K1PAISCSV='"1";"A"\n"2";"B"\n')  # one member fewer
    assert run() == {"pais": (2, 0), "moti": (0, 0)}  # the other archive is left alone
    assert (rows("pais"), rows("moti"), rows("munic")) == (2, 0, 1)
    os.remove(raw / "b.zip")
    assert run()["munic"] == (0, 0) and rows("munic") == 0 and rows("pais") == 2
    assert spark.table("archives.munic").count() == 0
    write(raw / "K9.MUNICCSV", ['"1";"A"'])
    os.remove(raw / "a.zip")
    assert run() == {"munic": (1, 0), "pais": (0, 0)}  # moti was empty before
    assert rows("pais") == 0 and spark.table("archives.pais").count() == 0
    assert run() == {}


@pytest.mark.parametrize("rows", [150, 30_000])
def test_pieces_to_compact_do_not_grow_with_the_input(spark, tmp_path, monkeypatch, rows):
    spark.range(rows).selectExpr(
        "id AS c_custkey", "concat('Customer#', id) AS c_name", "CAST(id % 25 AS INT) AS c_nationkey",
    ).write.parquet(str(tmp_path / "customer.parquet"))
    pieces, compact = [], check_store.publish.compact

    def counting(spark, root, table, month):
        pieces.append(len(check_store.publish.read_table(spark, root, table, month).inputFiles()))
        return compact(spark, root, table, month)

    monkeypatch.setattr(check_store.publish, "compact", counting)
    got = QUERIES["q_compact"](spark, str(tmp_path)).first()
    assert got["n"] == rows * 2 // 3 and got["fewer_files"] and got["again"] == 0
    assert 2 < pieces[0] <= 2 * (check_store.PIECES + 1) and pieces[1] == 2
