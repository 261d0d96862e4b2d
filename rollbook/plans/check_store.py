"""Registered queries: the published store, its indexes, versions and streams."""

from __future__ import annotations

import io
import zipfile
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.operators import relate
from rollbook.plans import load, publish
from rollbook.plans.check_files import raw_registry, write_delimited
from rollbook.plans.registered import query, table
from rollbook.schema import REGISTRY
from rollbook.session import setting, workspace
from rollbook.sinks import versions
from rollbook.streaming import files as stream

MONTH = "2025-10"

# -- indexes --------------------------------------------------------------------------

# Raw files whose lookup columns take many values, filled from the given tables and written
# in order, as a published extract is: a file per range of keys.
_STATES = ("SP", "RJ", "MG", "BA", "RS", "PR", "AC")
_STATE = "CASE o_orderkey // 4096 % 7 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_STATES)) + " END"
_INDEXED = {
    "estabelecimento": ("orders", "o_orderkey", {
        "cnpj_basico": "lpad(CAST(o_orderkey AS STRING), 12, '0')",
        "nome_fantasia": "CASE WHEN o_orderkey % 1013 = 0 THEN 'EDIFÍCIO ' || o_orderstatus || ' Nº ' || "
                         "CAST(o_orderkey AS STRING) ELSE o_orderpriority END",
        "cnae_fiscal_principal": "CAST(o_orderkey // 64 AS STRING)",
        "uf": _STATE,
        "municipio": "CAST(o_orderkey // 512 AS STRING)",
    }),
    "empresa": ("customer", "c_custkey", {
        "cnpj_basico": "lpad(CAST(c_custkey AS STRING), 12, '0')",
        "razao_social": "c_name",
        "natureza_juridica": "CAST(c_custkey // 32 AS STRING)",
    }),
    "socios": ("supplier", "s_suppkey", {
        "cnpj_basico": "lpad(CAST(s_suppkey AS STRING), 12, '0')",
        "nome_socio_razao_social": "s_name",
        "cpf_cnpj_socio": "lpad(CAST(s_suppkey * 7 AS STRING), 11, '0')",
    }),
}
FILES = 8
PIECES = 64  # of a file that is loaded in small ones


def _spark(expr: str) -> str:
    return expr.replace("//", "div")


def indexed_store(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """A published store of these tables."""
    folder = workspace(spark, "indexed")
    for name in names:
        source, key, cells = _INDEXED[name]
        row = [f"{_spark(cells.get(c, chr(39) * 2))} AS {c}" for c in REGISTRY[name].columns]
        rows = table(spark, sf_dir, source).repartitionByRange(FILES, key).selectExpr(*row)
        write_delimited(rows, f"{folder}/raw/K1.{REGISTRY[name].pattern}")
    publish.load_changed(spark, f"{folder}/raw", f"{folder}/tables", MONTH)
    return f"{folder}/tables"


#: Lookups by each indexed column, and by two of them at once.
LOOKUPS: tuple[tuple[str, dict[str, object]], ...] = (
    ("estabelecimento", {"uf": "RJ"}),
    ("estabelecimento", {"municipio": 2}),
    ("estabelecimento", {"cnae_fiscal_principal": 17}),
    ("estabelecimento", {"uf": "SP", "municipio": 1}),
    ("empresa", {"natureza_juridica": 1}),
    ("socios", {"cpf_cnpj_socio": "00000000049"}),
)


def _lookup_sql() -> str:
    parts = []
    for name, where in LOOKUPS:
        source, _, cells = _INDEXED[name]
        told = " AND ".join(
            f"{cells[c]} = '{v}'" if isinstance(v, str) else f"CAST({cells[c]} AS INTEGER) = {v}"
            for c, v in where.items()
        )
        label = ",".join(where)
        parts.append(f"SELECT '{label}' AS looked_up, {cells['cnpj_basico']} AS cnpj_basico FROM {source} WHERE {told}")
    return " UNION ALL ".join(parts)


@query(_lookup_sql())
def q_indexed_lookup(spark, sf_dir):
    """Lookups by the five indexed columns read only the files that the indexes name."""
    root = indexed_store(spark, sf_dir, *_INDEXED)
    found = [
        publish.lookup(spark, root, REGISTRY[name], where, MONTH).select(
            F.lit(",".join(where)).alias("looked_up"), "cnpj_basico"
        )
        for name, where in LOOKUPS
    ]
    return reduce(DataFrame.unionAll, found)


_NAME = _INDEXED["estabelecimento"][2]["nome_fantasia"]
_KEY = _INDEXED["estabelecimento"][2]["cnpj_basico"]


@query(f"""SELECT 'bytes' AS how, {_KEY} AS cnpj_basico FROM orders WHERE {_NAME} LIKE '%EDIFÍCIO F%'
OR {_NAME} LIKE '%IO O Nº%' UNION ALL SELECT 'ci_ai', {_KEY} FROM orders
WHERE contains(lower(strip_accents({_NAME})), 'edificio f') OR contains(lower(strip_accents({_NAME})), 'o o nº 1')""")
def q_indexed_search(spark, sf_dir):
    """Words inside texts, found through the trigram index, by bytes and by collation."""
    root = indexed_store(spark, sf_dir, "estabelecimento")
    branches = REGISTRY["estabelecimento"]
    exact = publish.search(spark, root, branches, "nome_fantasia", ("EDIFÍCIO F", "IO O Nº"))
    blind = publish.search(spark, root, branches, "nome_fantasia", ("edificio f", "ó Ó no 1"), ci_ai=True)
    return exact.select(F.lit("bytes").alias("how"), "cnpj_basico").unionAll(
        blind.select(F.lit("ci_ai").alias("how"), "cnpj_basico")
    )


# -- one file, one commit -----------------------------------------------------------------

_SEGMENT = "c_custkey % 3"


def customers_by_file(spark: SparkSession, sf_dir: str, raw: str, place: int, name: str = "c_name") -> None:
    """A third of the companies, as one folder of files."""
    cells = {
        "cnpj_basico": "lpad(CAST(c_custkey AS STRING), 12, '0')", "razao_social": name,
        "natureza_juridica": "CAST(c_nationkey AS STRING)",
    }
    row = [f"{cells.get(c, chr(39) * 2)} AS {c}" for c in REGISTRY["empresa"].columns]
    rows = table(spark, sf_dir, "customer").filter(f"{_SEGMENT} = {place}").selectExpr(*row)
    write_delimited(rows.coalesce(1), f"{raw}/K{place}.EMPRECSV")


def nations_by_file(spark: SparkSession, sf_dir: str, raw: str, place: int, code: str, name: str) -> None:
    rows = table(spark, sf_dir, "nation").filter(f"n_nationkey % 2 = {place}").selectExpr(
        f"{code} AS codigo", f"{name} AS nome"
    )
    write_delimited(rows.coalesce(1), f"{raw}/K{place}.PAISCSV")


@query(f"""SELECT 'empresa' AS table_name, lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS code,
CASE {_SEGMENT} WHEN 1 THEN 'new ' || c_name ELSE c_name END AS name, CAST(1 AS BIGINT) AS n_read FROM customer
WHERE {_SEGMENT} <> 2 UNION ALL SELECT 'pais', CAST(n_nationkey AS VARCHAR),
CASE WHEN n_nationkey % 2 = 0 THEN 'a ' || n_name ELSE n_name END, 1 FROM nation""")
def q_load_one_file(spark, sf_dir):
    """One file of companies and one of countries change and one of companies goes: only the changed
    ones are read again, and the tables are those of a load of all files.

    Countries of both files have the same codes at first; when the file whose rows had won
    changes its codes, rows of the other that were rejected come back.
    """
    folder = workspace(spark, "onefile")
    raw, root = f"{folder}/raw", f"{folder}/tables"
    for place in range(3):
        customers_by_file(spark, sf_dir, raw, place)
    nations_by_file(spark, sf_dir, raw, 0, "n_nationkey + 1", "'a ' || n_name")
    nations_by_file(spark, sf_dir, raw, 1, "n_nationkey", "n_name")
    publish.load_changed(spark, raw, root, MONTH)
    customers_by_file(spark, sf_dir, raw, 1, "'new ' || c_name")
    nations_by_file(spark, sf_dir, raw, 0, "n_nationkey", "'a ' || n_name")
    system, gone = versions.file_system(spark, f"{raw}/K2.EMPRECSV")
    system.delete(gone, True)
    again = publish.load_changed(spark, raw, root, MONTH)
    n_read = {
        name: len({path.rsplit("/", 2)[-2] for path in again.read if REGISTRY[name].pattern in path})
        for name in ("empresa", "pais")
    }
    parts = [
        publish.read_table(spark, root, REGISTRY[name], MONTH).select(
            F.lit(name).alias("table_name"), F.col(code).cast("string").alias("code"), F.col(text).alias("name"),
            F.lit(n_read[name]).cast("bigint").alias("n_read"),
        )
        for name, code, text in (("empresa", "cnpj_basico", "razao_social"), ("pais", "codigo", "nome"))
    ]
    return parts[0].unionAll(parts[1])


def damaged_archive(spark: SparkSession, path: str, member: str, lines: list[str]) -> None:
    """An archive whose directory is right and whose member is not."""
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        archive.writestr(member, "\n".join(f'"{i}";"{line}"' for i, line in enumerate(lines)))
    content = packed.getvalue().replace(lines[0].encode(), lines[0].encode()[::-1], 1)
    system, target = versions.file_system(spark, path)
    out = system.create(target, True)
    out.write(bytearray(content))
    out.close()


@query("""SELECT 'after the failed load' AS seen, 'pais' AS table_name, COUNT(*) FILTER (WHERE n_nationkey % 2 = 0) AS n
FROM nation UNION ALL SELECT 'after the failed load', 'empresa', COUNT(*) FILTER (WHERE c_custkey % 3 = 0) FROM customer
UNION ALL SELECT 'after the repeated load', 'pais', COUNT(*) FROM nation
UNION ALL SELECT 'after the repeated load', 'empresa', COUNT(*) FILTER (WHERE c_custkey % 3 < 2) FROM customer
UNION ALL SELECT 'version 1', 'pais', COUNT(*) FILTER (WHERE n_nationkey % 2 = 0) FROM nation
UNION ALL SELECT 'version 1', 'empresa', COUNT(*) FILTER (WHERE c_custkey % 3 = 0) FROM customer""")
def q_load_fails_half_way(spark, sf_dir):
    """A load breaks at a damaged archive while other tables are written: readers stay with the
    version before, for all tables; the repeated load publishes all at once."""
    folder = workspace(spark, "halfway")
    raw, root = f"{folder}/raw", f"{folder}/tables"
    customers_by_file(spark, sf_dir, raw, 0)
    nations_by_file(spark, sf_dir, raw, 0, "n_nationkey", "n_name")
    publish.load_changed(spark, raw, root, MONTH)
    customers_by_file(spark, sf_dir, raw, 1)
    nations_by_file(spark, sf_dir, raw, 1, "n_nationkey", "n_name")

    def counts(seen: str, version: int | None = None) -> DataFrame:
        return reduce(DataFrame.unionAll, [
            publish.read_table(spark, root, REGISTRY[name], MONTH, version).agg(F.count("*").alias("n")).select(
                F.lit(seen).alias("seen"), F.lit(name).alias("table_name"), "n"
            )
            for name in ("pais", "empresa")
        ])

    broken = f"{raw}/lists.zip"
    damaged_archive(spark, broken, "K1.MUNICCSV", [r["r_name"] for r in table(spark, sf_dir, "region").collect()])
    try:
        publish.load_changed(spark, raw, root, MONTH)
    except PySparkException:
        pass  # the member's checksum is wrong
    else:
        raise AssertionError("the damaged archive was loaded")
    counts("after the failed load").write.parquet(f"{folder}/failed")
    system, path = versions.file_system(spark, broken)
    system.delete(path, False)
    publish.load_changed(spark, raw, root, MONTH)
    return spark.read.parquet(f"{folder}/failed").unionAll(counts("after the repeated load")).unionAll(
        counts("version 1", 1)
    )


@query("""SELECT COUNT(*) AS n, CAST(SUM(c_custkey) AS BIGINT) AS total, true AS fewer_files,
CAST(0 AS BIGINT) AS again FROM customer WHERE c_custkey % 3 < 2""")
def q_compact(spark, sf_dir):
    """Two files that were loaded in many small pieces are stored in fewer files; the version
    before is still there, and a second run finds nothing to do."""
    folder = workspace(spark, "compact")
    raw, root, companies = f"{folder}/raw", f"{folder}/tables", REGISTRY["empresa"]
    for place in range(2):
        customers_by_file(spark, sf_dir, raw, place)
    # As many pieces whatever the files' size, as the setting also cuts all else that the load reads.
    size = min(publish.part_bytes(spark, f"{raw}/K{place}.EMPRECSV") for place in range(2))
    with setting(spark, "spark.sql.files.maxPartitionBytes", str(max(1, size // PIECES))):
        publish.load_changed(spark, raw, root, MONTH)
    publish.compact(spark, root, companies, MONTH)
    again = len(publish.compact(spark, root, companies, MONTH))
    before = publish.read_table(spark, root, companies, MONTH, version=1)
    after = publish.read_table(spark, root, companies, MONTH)
    fewer = len(after.inputFiles()) == 2 < len(before.inputFiles()) and before.exceptAll(after).isEmpty()
    return after.agg(
        F.count("*").alias("n"), F.sum(F.col("cnpj_basico").cast("bigint")).alias("total")
    ).withColumns({"fewer_files": F.lit(fewer), "again": F.lit(again).cast("bigint")})


# -- parts that come one after another ---------------------------------------------------------

_PADDED = "CASE WHEN p_partkey % 2 = 0 THEN lpad(CAST(p_partkey % 97 AS STRING), 4, '0') ELSE CAST(p_partkey % 97 AS STRING) END"


def list_files(spark: SparkSession, sf_dir: str, folder: str, place: int) -> None:
    """A file of a code list: codes come again within it and in the other files, spelled
    otherwise too."""
    rows = table(spark, sf_dir, "part").filter(f"p_partkey % 3 = {place}").selectExpr(
        f"{_PADDED} AS codigo", "CAST(p_partkey AS STRING) || ' ' || p_name AS nome"
    )
    write_delimited(rows.coalesce(1), f"{folder}/K{place}.MUNICCSV")


_FIRST_OF_KEY = """SELECT p_partkey % 97 AS code, p_partkey % 3 AS place, CAST(p_partkey AS VARCHAR) || ' ' || p_name AS nome,
row_number() OVER (PARTITION BY p_partkey % 97 ORDER BY p_partkey % 3,
  CASE WHEN p_partkey % 2 = 0 THEN lpad(CAST(p_partkey % 97 AS VARCHAR), 4, '0') ELSE CAST(p_partkey % 97 AS VARCHAR) END,
  CAST(p_partkey AS VARCHAR) || ' ' || p_name) AS turn FROM part"""


@query(f"""SELECT how, CAST(code AS INTEGER) AS codigo, nome, CAST(n AS BIGINT) AS n_rejected
FROM (SELECT * FROM ({_FIRST_OF_KEY}) WHERE turn = 1)
JOIN (SELECT p_partkey % 97 AS c, COUNT(*) - 1 AS n FROM part GROUP BY c) ON c = code,
(VALUES ('streamed'), ('appended')) h(how)""")
def q_stream_keys(spark, sf_dir):
    """Three files of a code list, one after another, streamed and appended: a code that an
    earlier file has brought is rejected."""
    folder = workspace(spark, "partkeys")
    cities = REGISTRY["munic"]
    for place in range(3):
        list_files(spark, sf_dir, f"{folder}/raw", place)
        stream.load_new(spark, cities, f"{folder}/raw", f"{folder}/streamed", f"{folder}/checkpoint", MONTH)
        load.load_table(
            spark, cities, load.Inputs([f"{folder}/raw/K{place}.MUNICCSV"]), f"{folder}/appended", MONTH,
            keep_existing=True,
        )
    parts = []
    for how in ("streamed", "appended"):
        rejects = load.read_rejects(spark, f"{folder}/{how}", cities, MONTH)
        lost = rejects.filter(F.array_contains("reasons", "codigo:duplicate_key")).groupBy(
            F.col("raw.codigo").cast("int").alias("codigo")
        ).agg(F.count("*").alias("n_rejected"))
        kept = load.read_table(spark, f"{folder}/{how}", cities, MONTH).select("codigo", "nome")
        parts.append(kept.join(lost, "codigo").select(F.lit(how).alias("how"), "codigo", "nome", "n_rejected"))
    return parts[0].unionAll(parts[1])


@query("""SELECT 'K' || CAST(s_suppkey % 4 AS VARCHAR) || '.SIMPLES.CSV' AS file,
COUNT(*) FILTER (WHERE s_suppkey % 9 <> 0) AS accepted, COUNT(*) FILTER (WHERE s_suppkey % 9 = 0) AS rejected,
CASE WHEN s_suppkey % 4 < 2 THEN 1 ELSE 2 END AS run FROM supplier GROUP BY ALL""")
def q_stream_counts(spark, sf_dir):
    """Rows per source file of a streamed month, taken batch by batch, over two runs."""
    folder = workspace(spark, "counts")
    simples = REGISTRY["simples"]
    cells = {
        "cnpj_basico": "lpad(CAST(s_suppkey AS STRING), 12, '0')",
        "opcao_simples": "CASE WHEN s_suppkey % 9 = 0 THEN 'SIM' ELSE 'S' END",
    }
    row = [f"{cells.get(c, chr(39) * 2)} AS {c}" for c in simples.columns]
    seen: list[DataFrame] = []
    for run, places in enumerate(((0, 1), (2, 3)), 1):
        for place in places:
            rows = table(spark, sf_dir, "supplier").filter(f"s_suppkey % 4 = {place}").selectExpr(*row)
            write_delimited(rows.coalesce(1), f"{folder}/raw/K{place}.SIMPLES.CSV")
        counts = stream.load_new(
            spark, simples, f"{folder}/raw", f"{folder}/out", f"{folder}/checkpoint", MONTH, max_files=1
        )
        fresh = counts.filter(F.col("file").rlike("K[" + "".join(map(str, places)) + "]"))
        seen.append(fresh.withColumn("run", F.lit(run)))
    rows = seen[0].unionAll(seen[1])
    return rows.select(F.element_at(F.split("file", "/"), -2).alias("file"), "accepted", "rejected", "run")


# Three codes of a customer: of nations, one of them twice, with an unknown one and blanks.
_LISTED = """CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN CAST(c_nationkey AS VARCHAR)
WHEN 2 THEN lpad(CAST(c_nationkey AS VARCHAR), 4, '0') || ',99,' || CAST(c_custkey % 25 AS VARCHAR) || ',,' || CAST(c_nationkey AS VARCHAR)
WHEN 3 THEN ' ' || CAST(c_custkey % 25 AS VARCHAR) || ' ,x' END"""


@query(f"""WITH listed AS (SELECT c_custkey, {_LISTED} AS codes FROM customer),
parts AS (SELECT c_custkey, unnest(string_split(codes, ',')) AS code,
  unnest(range(0, len(string_split(codes, ',')))) AS place FROM listed)
SELECT listed.c_custkey, CASE WHEN listed.codes IS NOT NULL THEN coalesce(string_agg(coalesce(n_name, '?'), '|' ORDER BY place)
  FILTER (WHERE trim(code) <> ''), '') END AS names
FROM listed LEFT JOIN parts ON parts.c_custkey = listed.c_custkey
LEFT JOIN nation ON n_nationkey = TRY_CAST(trim(code) AS INTEGER) GROUP BY listed.c_custkey, listed.codes""")
def q_decode_list(spark, sf_dir):
    """Codes listed in one text, decoded in their order."""
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey", f"{_LISTED.replace('VARCHAR', 'STRING')} AS codes")
    named = relate.decode_list(rows, table(spark, sf_dir, "nation"), "codes", "names", "n_nationkey", "n_name")
    return named.select(
        "c_custkey", F.array_join(F.transform("names", lambda n: F.coalesce(n, F.lit("?"))), "|").alias("names")
    )
