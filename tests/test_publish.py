"""The published store: replace by file, versions, indexes."""

import itertools
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from rollbook.functions.match import like_any
from rollbook.plans import load, publish
from rollbook.schema import LOOKUP_COLUMNS, REGISTRY, SEARCH_COLUMNS
from rollbook.sinks import index, layout, versions

EMPRESA, PAIS, BRANCHES = REGISTRY["empresa"], REGISTRY["pais"], REGISTRY["estabelecimento"]


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(("\n".join(lines) + "\n").encode("latin-1"))


def company(key, name, nature="2062"):
    return f'"{key}";"{name}";"{nature}";"49";"1,00";"05";""'


def branch(key, name, uf="SP", city="1", cnae="1"):
    cells = dict.fromkeys(BRANCHES.columns, "") | {
        "cnpj_basico": key, "nome_fantasia": name, "uf": uf, "municipio": city, "cnae_fiscal_principal": cnae}
    return ";".join(f'"{c}"' for c in cells.values())


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same_as_whole_load(spark, raw, root, whole, tables=REGISTRY, month="2025-10"):
    load.load_snapshot(spark, str(raw), str(whole), month)
    for table in tables.values():
        if not os.path.isdir(f"{whole}/{table.name}"):
            continue
        for ours, theirs in ((publish.read_table, load.read_table), (publish.read_rejects, load.read_rejects)):
            got = ours(spark, root, table, month)
            assert plain(got) == plain(theirs(spark, str(whole), table, month).select(*got.columns)), table.name


def test_a_changed_file_is_read_alone(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "o")
    for i in range(3):
        write(raw / f"K{i}.EMPRECSV", [company(f"{i}{j}", f"N{j}") for j in range(4)])
    first = publish.load_changed(spark, str(raw), root, "2025-10")
    assert first.version == 1 and first.counts == {"empresa": (12, 0)} and len(first.read) == 3
    before = {r["part"]: os.stat(f"{root}/{r['part']}").st_mtime_ns for r in versions.parts(spark, root)[1].collect()}
    write(raw / "K1.EMPRECSV", [company("19", "new"), '"bad";"x"' + ";" * 9])
    again = publish.load_changed(spark, str(raw), root, "2025-10")
    assert [p.rsplit("/", 1)[1] for p in again.read] == ["K1.EMPRECSV"] and again.counts == {"empresa": (9, 1)}
    after = [r["part"] for r in versions.parts(spark, root)[1].collect()]
    assert len(set(after) & set(before)) == 2  # two parts are the old ones, untouched
    assert all(os.stat(f"{root}/{p}").st_mtime_ns == before[p] for p in set(after) & set(before))
    same_as_whole_load(spark, raw, root, tmp_path / "whole")
    assert publish.load_changed(spark, str(raw), root, "2025-10").version is None
    assert publish.read_table(spark, root, EMPRESA, "2025-10", version=1).count() == 12


def test_keys_are_unique_over_files_as_in_a_whole_load(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "o")
    write(raw / "A.PAISCSV", ['"013";"A"', '"7";"SEVEN"', '"x";"?"'])
    write(raw / "B.PAISCSV", ['"13";"B"', '"13";"B"', '"8";"EIGHT"', '"";"none"'])
    publish.load_changed(spark, str(raw), root, "2025-10")
    same_as_whole_load(spark, raw, root, tmp_path / "w1")
    write(raw / "A.PAISCSV", ['"7";"SEVEN"', '"8";"AGAIN"', '"9";"NINE NINE"'])  # 13 of the other file comes back
    again = publish.load_changed(spark, str(raw), root, "2025-10")
    assert [p.rsplit("/", 1)[1] for p in again.read] == ["A.PAISCSV"]
    same_as_whole_load(spark, raw, root, tmp_path / "w2")
    (raw / "B.PAISCSV").unlink()
    publish.load_changed(spark, str(raw), root, "2025-10")
    same_as_whole_load(spark, raw, root, tmp_path / "w3")


def test_line_breaks_in_cells_are_found_while_loading(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "o")
    write(raw / "K0.EMPRECSV", [company("1", "one\nline ; \"\"two\"\""), company("2", "x")])
    write(raw / "K1.EMPRECSV", [company("3", "plain"), company("4", 'stray " quote')])
    write(raw / "K2.EMPRECSV", [""])
    done = publish.load_changed(spark, str(raw), root, "2025-10")
    assert done.counts["empresa"] == (4, 0)
    same_as_whole_load(spark, raw, root, tmp_path / "whole")


def test_odd_names_months_and_archives(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "o")
    write(raw / "EMPRE dir" / "K 1%20ç.SIMPLES.CSV", ['"1";"S";"";"";"N";"";""'])
    (raw / "K1.MOTICSV").write_bytes(b"")
    with zipfile.ZipFile(raw / "lists.zip", "w") as z:
        z.writestr("sub/F.K1.PAISCSV", b'"105";"BRASIL"\n')
        z.writestr("LEIAME", b"nothing")
    for month in ("2025-09", "2025-10"):
        done = publish.load_changed(spark, str(raw), root, month, database="odd_months")
        assert done.counts == {"moti": (0, 0), "pais": (1, 0), "simples": (1, 0)} and not done.failed
    assert publish.read_table(spark, root, REGISTRY["moti"]).count() == 0
    assert plain(publish.read_table(spark, root, PAIS).select("snapshot")) == [("2025-09",), ("2025-10",)]
    assert plain(spark.table("odd_months.simples").select("snapshot")) == [("2025-09",), ("2025-10",)]
    assert all(f.startswith(f"file://{root}/_catalog/") for f in spark.table("odd_months.simples").inputFiles())


def test_one_of_two_writers_is_told(spark, tmp_path):
    root = str(tmp_path / "o")
    rows = versions.as_parts(spark, [("t", "m", "s", 1, None, None, 0, 0, 0)])
    assert versions.publish(spark, root, 0, rows) == 1
    with pytest.raises(versions.Conflict):
        versions.publish(spark, root, 0, rows)
    assert versions.numbers(spark, root) == [1]
    os.remove(f"{versions.path_of(root, 1)}/_SUCCESS")
    assert versions.parts(spark, root)[0] == 0  # not all there: no version


def test_old_versions_are_forgotten(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "o")
    for name in ("one", "two two", "three three"):
        write(raw / "K0.EMPRECSV", [company("1", name)])
        publish.load_changed(spark, str(raw), root, "2025-10")
    assert len(os.listdir(f"{root}/empresa")) == 3
    versions.forget(spark, root, 2)
    assert versions.numbers(spark, root) == [2, 3] and len(os.listdir(f"{root}/empresa")) == 2
    assert len(os.listdir(f"{root}/_index/empresa")) == 2
    assert publish.read_table(spark, root, EMPRESA, version=2).first()["razao_social"] == "two two"
    with pytest.raises(ValueError):
        versions.forget(spark, root, 0)


def test_parts_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """More files than a task writes side by side, read by one task."""
    key, most = publish.UNSORTED
    for i in range(7):
        write(tmp_path / f"raw/K{i}.EMPRECSV", [company(f"{i}{j:03}", f"N {i}") for j in range(5)])
    seen, write_parts = [], publish.write_parts

    def looking(*args):
        seen.append(spark.conf.get(key))
        return write_parts(*args)

    monkeypatch.setattr(publish, "write_parts", looking)
    before = spark.conf.get(key)
    root = str(tmp_path / "tables")
    done = publish.load_changed(spark, str(tmp_path / "raw"), root, "2025-10", tables={"empresa": EMPRESA})
    assert seen == [most] and spark.conf.get(key) == before != most and done.counts == {"empresa": (35, 0)}
    got = publish.read_table(spark, root, EMPRESA, "2025-10")
    assert sorted(r[0] for r in got.select("cnpj_basico").collect()) == [f"{i}{j:03}" for i in range(7) for j in range(5)]


def test_compaction_keeps_rows_indexes_and_replacing(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "o")
    for i in range(2):
        write(raw / f"K{i}.EMPRECSV", [company(f"{i}{j:04d}", f"NAME {j}", str(j % 7)) for j in range(300)])
    split = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(split, "3000")
    try:
        publish.load_changed(spark, str(raw), root, "2025-10")
    finally:
        spark.conf.unset(split)
    before = publish.read_table(spark, root, EMPRESA, "2025-10")
    rows = plain(before)
    assert len(before.inputFiles()) > 8
    assert len(publish.compact(spark, root, EMPRESA, "2025-10")) == 2
    after = publish.read_table(spark, root, EMPRESA, "2025-10")
    assert len(after.inputFiles()) == 2 and plain(after) == rows
    assert publish.compact(spark, root, EMPRESA, "2025-10") == []
    assert plain(publish.read_table(spark, root, EMPRESA, "2025-10", version=1)) == rows
    found = publish.lookup(spark, root, EMPRESA, {"natureza_juridica": 3})
    assert plain(found) == [r for r in rows if r[2] == 3]
    write(raw / "K1.EMPRECSV", [company("9", "new")])
    again = publish.load_changed(spark, str(raw), root, "2025-10")
    assert again.counts == {"empresa": (301, 0)} and len(again.read) == 1


# -- indexes ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("indexed")
    names = ["Condomínio X", "CONDOMINIO Y", "Edifício Nº 1", "strasse", "STRAßE", "ÆSOP", "日本 Ltda", "a\xadb c", "", "ab"]
    for i, name in enumerate(names):
        text = name.encode("latin-1", "ignore").decode("latin-1")
        write(folder / "raw" / f"K{i}.ESTABELE", [
            branch(f"{i}", text, uf=("SP", "RJ")[i % 2], city=str(i // 2), cnae=str(i)), branch(f"x{i}", "other", "AC", "77", "99")])
    root = str(folder / "o")
    publish.load_changed(spark, str(folder / "raw"), root, "2025-10")
    return root


def files_read(df):
    return len(df.inputFiles())


def test_lookups_read_the_listed_files_only(spark, store):
    whole = publish.read_table(spark, store, BRANCHES, "2025-10")
    assert files_read(whole) == 10
    for where, n in (({"uf": "SP"}, 5), ({"municipio": 3}, 2), ({"cnae_fiscal_principal": 4}, 1),
                     ({"uf": "RJ", "municipio": 0}, 1), ({"uf": "AC"}, 10)):
        found = publish.lookup(spark, store, BRANCHES, where, "2025-10")
        assert files_read(found) == n, where
        told = whole
        for c, v in where.items():
            told = told.filter(F.col(c) == F.lit(v))
        assert plain(found) == plain(told)
    assert publish.lookup(spark, store, BRANCHES, {"uf": "ZZ"}, "2025-10").count() == 0
    assert publish.lookup(spark, store, BRANCHES, {"uf": "SP"}, "2025-11").count() == 0
    by_key = publish.lookup(spark, store, BRANCHES, {"cnpj_basico": "3"})  # without an index
    assert by_key.count() == 1 and files_read(by_key) == 10


def test_searches_read_fewer_files_and_find_the_same(spark, store):
    whole = publish.read_table(spark, store, BRANCHES, "2025-10")
    for words, ci_ai in itertools.product(
        (["Condom"], ["condominio"], ["CONDOMÍNIO", "nº 1"], ["ssE"], ["aesop"], ["abc"], ["ab"], ["b c"], ["other"],
         ["日本 l"], ["Ltd"], ["zzz"], ["\xad\xad\xad"]), (False, True)
    ):
        found = publish.search(spark, store, BRANCHES, "nome_fantasia", words, ci_ai, "2025-10")
        assert plain(found) == plain(whole.filter(like_any(F.col("nome_fantasia"), words, ci_ai))), (words, ci_ai)
    assert files_read(publish.search(spark, store, BRANCHES, "nome_fantasia", ["Condom"])) == 2
    blind = publish.search(spark, store, BRANCHES, "nome_fantasia", ["condomínio"], ci_ai=True)
    assert files_read(blind) == 2 and blind.count() == 2
    assert files_read(publish.search(spark, store, BRANCHES, "nome_fantasia", ["ab"])) == 10  # too short


def test_the_fold_never_parts_what_the_collation_joins(spark):
    chars = [chr(i) for i in range(1, 256)] + ["ss", "ae"]
    one = spark.createDataFrame([(c,) for c in chars], "a string").select("a", index.fold(F.col("a")).alias("fa"))
    two = one.select(F.col("a").alias("b"), F.col("fa").alias("fb"))
    apart = one.join(two, (F.collate("a", "UNICODE_CI_AI") == F.collate("b", "UNICODE_CI_AI")) & (F.col("fa") != F.col("fb")))
    assert apart.collect() == []


def test_texts_beyond_latin_1_are_always_read_by_collation(spark, tmp_path):
    rows = [("1", "ＣＯＮＤＯＭＩＮＩＯ"), ("2", "condominio"), ("3", "ΟΔΟΣΑ"), ("4", "nothing")]
    path = str(tmp_path / "t" / "l")
    frame = spark.createDataFrame(rows, "source string, name string").repartition(4, "source")
    frame.write.partitionBy("source").parquet(path)
    stored = spark.read.parquet(path)
    index.build(stored, index.GRAMS, "name", index.path_of(str(tmp_path), "t", "l", index.GRAMS, "name"))
    parts = {"m": [f"t/l/source={i}" for i in range(1, 5)]}

    def hit(words, ci_ai):
        found = index.narrowed(spark, str(tmp_path), "t", parts, [(index.GRAMS, "name", words, ci_ai)])["m"]
        return sorted({f.split("source=")[1][0] for f in found})

    assert hit(["domin"], False) == ["2"] and hit(["domin"], True) == ["1", "2", "3"]
    assert hit(["ΟΔΟΣ"], False) == ["3"]  # final sigma is no other letter here
    assert hit(["ΟΔΟΣ"], True) == ["1", "2", "3", "4"]


def test_an_index_that_fails_does_not_stop_the_load(spark, tmp_path, monkeypatch):
    write(tmp_path / "raw" / "K0.ESTABELE", [branch("1", "Condomínio", "SP")])
    real = index.build
    monkeypatch.setattr(index, "build", lambda rows, kind, column, path: 1 / 0 if column == "uf" else real(rows, kind, column, path))
    done = publish.load_changed(spark, str(tmp_path / "raw"), str(tmp_path / "o"), "2025-10")
    assert done.version == 1 and list(done.failed["estabelecimento"]) == ["uf"]
    assert publish.lookup(spark, str(tmp_path / "o"), BRANCHES, {"uf": "SP", "municipio": 1}).count() == 1


def test_declared_index_columns_exist():
    for columns_of in (LOOKUP_COLUMNS, SEARCH_COLUMNS):
        for table, columns in columns_of.items():
            assert set(columns) <= set(REGISTRY[table].columns)


def test_bucket_counts_follow_bytes():
    assert [layout.bucket_count(n << 20) for n in (0, 1, 256, 257, 1000, 10_000)] == [1, 1, 1, 2, 4, 64]
