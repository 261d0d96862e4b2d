"""Scans of byte-exact files, plain and zipped, and the file listing."""

import itertools
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from rollbook.operators.shape import typed, typed_with_reasons
from rollbook.schema import REGISTRY, Table, integer, text
from rollbook.sources import archive, delimited, files, jdbc
from rollbook.sources import records as rec
from rollbook.sources.delimited import LONG_RECORD, SOURCE_FILE, scan_delimited, snapshot_of

FOUR = Table("four", (text("a"), text("b"), integer("c"), text("d")))

PLAIN = [
    '1;"semi;colon";"7";"doubled ""quote"""',
    '2;unquoted;8;back\\',
    '3;"";;""',
    "4;NULL;null; NULL ",
    "",
    "   ",
    '5;"Ação";"9";"café"',
    "6;short",
    "7;long;1;x;extra",
    '8;"quoted;long";1;x;',
    '9;stray 5" pipe;2;x',
]
WITH_BREAK = PLAIN + ['10;"line one\nline two";3;"a ""b""\nc;d"', "11;after;4;x"]

EXPECTED = {
    "1": ("semi;colon", "7", 'doubled "quote"', False),
    "2": ("unquoted", "8", "back\\", False),
    "3": (None, None, None, False),
    "4": (None, None, " NULL ", False),
    "5": ("Ação", "9", "café", False),
    "6": ("short", None, None, False),
    "7": ("long", "1", "x", True),
    "8": ("quoted;long", "1", "x", True),
    "9": ('stray 5" pipe', "2", "x", False),
}
EXPECTED_BREAK = EXPECTED | {
    "10": ("line one\nline two", "3", 'a "b"\nc;d', False),
    "11": ("after", "4", "x", False),
}


def rows(df):
    got = df.select("a", "b", "c", "d", F.col(LONG_RECORD).isNotNull().alias("long")).collect()
    assert len({r["a"] for r in got}) == len(got)
    return {r["a"]: (r["b"], r["c"], r["d"], r["long"]) for r in got}


def write(path, lines, end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(end.join(lines).encode("latin-1") + end.encode())
    return str(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_plain_file(spark, tmp_path, end):
    path = write(tmp_path / "p.csv", PLAIN, end)
    assert rows(scan_delimited(spark, FOUR, path)) == EXPECTED
    assert rows(scan_delimited(spark, FOUR, path, multi_line=False)) == EXPECTED
    assert scan_delimited(spark, FOUR, path).count() == len(EXPECTED)
    few = scan_delimited(spark, FOUR, path).filter(F.col(LONG_RECORD).isNotNull()).select("a")
    assert sorted(r["a"] for r in few.collect()) == ["7", "8"]


def test_line_breaks_are_found_per_file(spark, tmp_path, monkeypatch):
    broken = write(tmp_path / "in" / "with space.csv", WITH_BREAK)
    plain = write(tmp_path / "in" / "plain.csv", ['20;"x";1;"y"', "21;x;1;y"])
    want = EXPECTED_BREAK | {"20": ("x", "1", "y", False), "21": ("x", "1", "y", False)}
    assert rows(scan_delimited(spark, FOUR, [broken, plain])) == want
    assert rows(scan_delimited(spark, FOUR, str(tmp_path / "in"))) == want
    monkeypatch.setattr(delimited, "NAMED_FILES", 0)  # joined instead of named
    assert rows(scan_delimited(spark, FOUR, str(tmp_path / "in"))) == want


OPEN = ['1;"open', '1;"a";"b ""', '"', 'x;"""', '5";"abc', '5";"abc";"de', ';"a;b', '"a""']
CLOSED = ['1;"a"', '"a;"""', "", ";;", '"a""b";c', '"";""', '"""a"""', 'a;"b;c"']


def test_open_lines_are_always_flagged(spark):
    df = spark.createDataFrame([(x,) for x in OPEN + CLOSED], "x string")
    got = {r["x"]: r["f"] for r in df.select("x", delimited.may_continue(F.col("x")).alias("f")).collect()}
    closed = rec.closed_record(";")
    assert all(got[x] for x in OPEN)
    assert not any(got[x] for x in CLOSED)
    assert not any(closed.fullmatch(x) for x in OPEN)
    assert all(closed.fullmatch(x) for x in CLOSED)


def test_zip_and_plain_agree(spark, tmp_path):
    plain = write(tmp_path / "p" / "a.csv", WITH_BREAK)
    os.makedirs(tmp_path / "z")
    half = WITH_BREAK.index(PLAIN[6])
    with zipfile.ZipFile(tmp_path / "z" / "one.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("first.csv", "\n".join(WITH_BREAK[:half]).encode("latin-1") + b"\n")
    with zipfile.ZipFile(tmp_path / "z" / "two.ZIP", "w") as z:
        z.writestr("folder/second.csv", "\r\n".join(WITH_BREAK[half:]).encode("latin-1"))
        z.writestr("empty.csv", b"")
    zipped = archive.scan_zip(spark, FOUR, str(tmp_path / "z"))
    assert zipped.columns == scan_delimited(spark, FOUR, plain).columns
    assert rows(zipped) == rows(scan_delimited(spark, FOUR, plain)) == EXPECTED_BREAK
    assert {r[0].rsplit("/", 1)[1] for r in zipped.select(SOURCE_FILE).distinct().collect()} == {
        "one.zip!first.csv", "second.csv"
    }


@pytest.mark.parametrize("size", [1, 7, 16, 40, 1000])
def test_big_files_are_split_exactly(spark, tmp_path, size):
    """Splits of a few bytes, so that records and even cells cross many of them."""
    lines = WITH_BREAK + ['12;"a\n\n""b;\n";5;"\n"', '13;"";6;x', '14;"x\ny";7;"z\n\n\n\nz"', "15;e;8;"]
    path = write(tmp_path / "big.csv", lines)
    write(tmp_path / "other.csv", ['30;"p\nq";1;z', "31;x;1;y"])
    whole = scan_delimited(spark, FOUR, str(tmp_path), multi_line=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        split = scan_delimited(spark, FOUR, str(tmp_path))
        lines_read = rec.read_lines(spark, [path], "ISO-8859-1")
        assert lines_read.rdd.getNumPartitions() > (1 if size < 200 else 0)
        got = rows(split)
        sources = {r[0].rsplit("/", 1)[1] for r in split.select(SOURCE_FILE).distinct().collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == rows(whole)
    assert sources == {"big.csv", "other.csv"}


def test_split_starts(spark):
    # (path, start, length, open after a closed start, after an open start, closes)
    ends = [("f", 0, 10, True, False, True), ("f", 10, 10, False, True, False),
            ("f", 20, 10, False, True, False), ("f", 30, 10, False, True, True),
            ("f", 40, 10, False, False, True), ("g", 0, 10, False, True, False)]
    found = rec.split_starts(spark.createDataFrame(ends, rec.ENDS))
    got = {(r["path"], r["start"]): r["origin"] for r in found.collect()}
    assert got == {("f", 0): None, ("f", 10): 0, ("f", 20): 0, ("f", 30): 0, ("f", 40): 30, ("g", 0): None}


def test_changed_splits_are_an_error(spark, tmp_path):
    """Never wrong records: the same ones, or an error that says what to do."""
    lines = [f'{i};"a\nb {i}";1;x' for i in range(400)]
    write(tmp_path / "f.csv", lines)
    before = scan_delimited(spark, FOUR, str(tmp_path))
    want = rows(before)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        with pytest.raises(Exception, match="build it again"):
            rows(before)
        assert rows(scan_delimited(spark, FOUR, str(tmp_path))) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rows(before) == want


def test_carriage_returns(spark, tmp_path):
    """Kept in cells, taken off record ends; alike plain, split and zipped."""
    raw = b'1;"a\r\nb";x;NULL\r\n2;"c\rd";"e\nf";"null"\r\n3;"p";q;"r"\r\n4;"s\r";t;u\n\r\n5;;;\r\n'
    want = {"1": ("a\r\nb", "x", None, False), "2": ("c\rd", "e\nf", None, False),
            "3": ("p", "q", "r", False), "4": ("s\r", "t", "u", False), "5": (None, None, None, False)}
    (tmp_path / "p").mkdir()
    (tmp_path / "z").mkdir()
    (tmp_path / "p" / "a.csv").write_bytes(raw)
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "a.csv").write_bytes(raw.split(b"\n2;")[0].split(b"\n", 1)[1] + b"\n" + raw[raw.index(b"3;"):])
    with zipfile.ZipFile(tmp_path / "z" / "a.zip", "w") as z:
        z.writestr("a.csv", raw)
    assert rows(scan_delimited(spark, FOUR, str(tmp_path / "p"))) == want
    assert rows(archive.scan_zip(spark, FOUR, str(tmp_path / "z"))) == want
    lines_only = rows(scan_delimited(spark, FOUR, str(tmp_path / "q"), multi_line=False))
    assert {k: lines_only[k] for k in "345"} == {k: want[k] for k in "345"}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert rows(scan_delimited(spark, FOUR, str(tmp_path / "p"))) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_quote_left_open_is_set_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rec, "MOST_CHARS", 200)
    lines = ["1;a;b;c", '2;"open;x;y', *[f"line {i};x;y;z" for i in range(60)]]
    write(tmp_path / "f.csv", lines)
    for size in ("128m", "100"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            found = scan_delimited(spark, FOUR, str(tmp_path)).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert sorted(r["a"] or "" for r in found) == ["", "1"]
        assert [r[LONG_RECORD][:10] for r in found if r["a"] is None] == ["record of "]


def test_unknown_stores_fail_early(spark):
    with pytest.raises(ValueError, match="abfss"):
        archive.list_members(spark, "abfss://c@x/y.zip")


def test_broken_archive_fails(spark, tmp_path):
    (tmp_path / "bad.zip").write_bytes(b"this is no archive")
    with pytest.raises(Exception, match="not a zip file"):
        archive.scan_zip(spark, FOUR, str(tmp_path)).count()


def test_lines_across_block_borders():
    whole = "a;b\r\nc;d\ne\rf\r\n\r\ng"
    for size in range(1, len(whole) + 1):
        blocks = [whole[i:i + size] for i in range(0, len(whole), size)]
        lines = list(rec.text_lines(blocks))
        assert lines == whole.split("\n")


def test_only_the_needed_python_node(spark, tmp_path, plan):
    path = write(tmp_path / "p.csv", PLAIN)
    text_plan = plan(typed_with_reasons(scan_delimited(spark, FOUR, path, multi_line=False), FOUR))
    assert "Python" not in text_plan and "MapIn" not in text_plan


def test_typed_and_rejected(spark, tmp_path):
    path = write(tmp_path / "p.csv", PLAIN)
    checked = typed_with_reasons(scan_delimited(spark, FOUR, path), FOUR).collect()
    assert {r["a"]: r["reasons"] for r in checked if r["rejected"]} == {
        "7": ["row:too_many_cells"], "8": ["row:too_many_cells"]
    }
    assert all(r["raw"] is None for r in checked if not r["rejected"])


def test_absent_columns_are_skipped(spark):
    raw = spark.createDataFrame([("x", "1")], "a string, c string")
    assert typed(raw, FOUR).columns == ["a", "c"]


def test_route(spark):
    names = {
        "x.EMPRECSV": "empresa", "x.estabele": "estabelecimento", "SOCIO_EMPRE": "empresa",
        "K.SocioCsv": "socios", "F.SIMPLES.CSV": "simples", "QUALSCSV": "quals", "readme": None,
        "F.CNAECSV": "cnae", "F.MOTICSV": "moti", "F.MUNICCSV": "munic", "F.NATJUCSV": "natju",
        "F.PAISCSV": "pais",
    }
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert {r[0]: r[1] for r in df.select("name", files.route(F.col("name"))).collect()} == names
    counts = {r[0]: r[1] for r in files.count_routed(df.filter("name like '%EMPRE%'")).collect()}
    assert counts == {t: 0 for t in REGISTRY} | {"empresa": 2}


def test_listing_opens_no_file(spark, tmp_path, plan):
    write(tmp_path / "raw" / "K.EMPRECSV" / "part-0", ["abc"])
    found = files.list_files(spark, str(tmp_path / "raw"))
    assert [(r["name"], r["size"]) for r in found.collect()] == [("K.EMPRECSV", 4)]
    assert "content" not in plan(found).split("ReadSchema")[1]


def test_snapshot_of(spark):
    df = spark.createDataFrame([("https://h/dados/2025-10/",), ("/x/2024-01",), ("/x/y",)], "p string")
    assert [r[0] for r in df.select(snapshot_of(F.col("p"))).collect()] == ["2025-10", "2024-01", ""]


def test_jdbc_options():
    whole = jdbc.read_options("jdbc:x:y", "t")
    assert whole["pushDownPredicate"] == "true" and "numPartitions" not in whole
    sliced = jdbc.read_options("jdbc:x:y", "t", jdbc.Slices("id", "0", "100", 4), user="u")
    assert sliced["partitionColumn"] == "id" and sliced["numPartitions"] == "4"
    assert sliced["user"] == "u"


def test_lines_are_parsed_once(spark, plan, tmp_path):
    """No filter is pushed below the parser, which would parse each line again for it."""
    path = tmp_path / "lines.csv"
    path.write_bytes(("\n".join(PLAIN) + "\n \r\n\r\n").encode("latin-1"))
    for options in ({"mark_open": True}, {"multi_line": False}):
        found = scan_delimited(spark, FOUR, str(path), **options)
        assert plan(found).count("from_csv(") == 1
        assert found.count() == len([line for line in PLAIN if line.strip()])


def test_whole_cells_are_seen_as_taking_lines_apart_does(spark):
    ends = ["", '"', '""', '"a;b"', "a", 'a"b', '"a', '"a""b"', ' "a"', "\r"]
    lines = [";".join(cells) for n in (1, 2, 3) for cells in itertools.product(ends, repeat=n)]
    line = F.col("line")
    apart = line.contains('"') & delimited._without_quoted_cells(line, ";").contains('"')
    frame = spark.createDataFrame([(x,) for x in lines], "line string")
    assert frame.filter(delimited.may_continue(line) != apart).count() == 0
