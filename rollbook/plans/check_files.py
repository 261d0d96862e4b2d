"""Registered queries: scans, listings, links, manifests, sinks and the load.

Queries that write do so in a fresh folder of the shared workspace and return a
DataFrame that reads it back.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.operators import manifest, pages, shape
from rollbook.plans import dirty, load, publish
from rollbook.plans.registered import query, table
from rollbook.schema import REGISTRY, Table
from rollbook.session import workspace
from rollbook.sinks import layout
from rollbook.sinks import tables as sink
from rollbook.sources.archive import open_path, scan_zip
from rollbook.sources.delimited import SOURCE_FILE, scan_delimited, snapshot_of
from rollbook.sources.files import count_routed
from rollbook.streaming import files as stream

FILE_OPTIONS = {"sep": ";", "quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
                "ignoreTrailingWhiteSpace": "false"}


# -- scans ------------------------------------------------------------------------

def write_delimited(raw: DataFrame, path: str) -> None:
    raw.write.mode("overwrite").options(**FILE_OPTIONS, encoding="ISO-8859-1").csv(path)


def write_zips(raw: DataFrame, folder: str) -> None:
    """Each partition becomes one archive, streamed.  The name is the partition's,
    and an archive only appears complete, so a repeated task changes nothing."""
    lines = raw.select(F.to_csv(F.struct(*raw.columns), FILE_OPTIONS).alias("line"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, target = open_path(f"{folder}/part-{task.partitionId():06d}.zip")
        partial = f"{target}.{task.taskAttemptId()}.partial"
        system.create_dir(target.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(partial) as out, zipfile.ZipFile(
            out, "w", zipfile.ZIP_DEFLATED
        ) as archive, archive.open("customer.csv", "w", force_zip64=True) as member:
            for batch in batches:
                for line in batch.column(0).to_pylist():
                    member.write(line.encode("latin-1") + b"\n")
        system.move(partial, target)
        yield pa.RecordBatch.from_pydict({"archive": [target]})

    lines.mapInArrow(write, "archive string").write.format("noop").mode("overwrite").save()


def customer_cells(spark: SparkSession, sf_dir: str, line_breaks: bool) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", *dirty.columns(dirty.customer(line_breaks))
    )


def _customer_sql(line_breaks: bool, extra: str = "") -> str:
    cells = dirty.select_list(dirty.customer(line_breaks))
    return (f"SELECT {dirty.sql_typed(dirty.CUSTOMER)}{extra} FROM "
            f"(SELECT c_custkey, {cells} FROM customer)")


@query(_customer_sql(False))
def q_scan_csv(spark, sf_dir):
    folder = workspace(spark, "csv")
    write_delimited(customer_cells(spark, sf_dir, False).drop("c_custkey"), folder)
    return shape.typed(scan_delimited(spark, dirty.CUSTOMER, folder), dirty.CUSTOMER)


@query(_customer_sql(True, ", CASE WHEN c_custkey % 5 = 3 THEN 'broken' ELSE 'plain' END AS folder"))
def q_scan_multi(spark, sf_dir):
    folder = workspace(spark, "multi")
    cells = customer_cells(spark, sf_dir, True)
    write_delimited(cells.filter("c_custkey % 5 = 3").drop("c_custkey"), f"{folder}/broken")
    write_delimited(cells.filter("c_custkey % 5 <> 3").drop("c_custkey"), f"{folder}/plain")
    raw = scan_delimited(spark, dirty.CUSTOMER, [f"{folder}/broken", f"{folder}/plain"])
    name = F.regexp_extract(SOURCE_FILE, "/([^/]+)/[^/]+$", 1).alias("folder")
    return shape.typed(raw, dirty.CUSTOMER, name)


@query(_customer_sql(True))
def q_scan_split(spark, sf_dir):
    """Files with line breaks in cells, read by as many tasks as they have splits."""
    folder = workspace(spark, "split")
    write_delimited(customer_cells(spark, sf_dir, True).drop("c_custkey"), folder)
    raw = scan_delimited(spark, dirty.CUSTOMER, folder, multi_line=True)
    return shape.typed(raw, dirty.CUSTOMER)


@query(_customer_sql(True))
def q_scan_zip(spark, sf_dir):
    folder = workspace(spark, "zip")
    write_zips(customer_cells(spark, sf_dir, True).drop("c_custkey"), folder)
    return shape.typed(scan_zip(spark, dirty.CUSTOMER, folder), dirty.CUSTOMER)


# -- listings, links, manifests -----------------------------------------------------

_FILE_NAME = """p_name || '.' || CASE p_partkey % 12 WHEN 0 THEN 'EMPRECSV' WHEN 1 THEN 'estabele'
WHEN 2 THEN 'SOCIO_EMPRE' WHEN 3 THEN 'SocioCsv' WHEN 4 THEN 'SIMPLES.CSV' WHEN 5 THEN 'CNAECSV'
WHEN 6 THEN 'MOTICSV' WHEN 7 THEN 'MUNICCSV' WHEN 8 THEN 'NATJUCSV' WHEN 9 THEN 'PAISCSV'
ELSE 'readme' END"""
# Fixed values, written out here apart from the declared tables: file name markers in
# routing order, and the markup patterns of links.
_MARKERS = (
    ("EMPRE", "empresa"), ("ESTABELE", "estabelecimento"), ("SOCIO", "socios"), ("SIMPLES", "simples"),
    ("CNAE", "cnae"), ("MOTI", "moti"), ("MUNIC", "munic"), ("NATJU", "natju"), ("PAIS", "pais"),
    ("QUALS", "quals"),
)
_ROUTE_SQL = "CASE " + " ".join(
    f"WHEN contains(upper(name), '{marker}') THEN '{name}'" for marker, name in _MARKERS
) + " END"


@query(f"""SELECT c.category, COUNT(f.category) AS n_files
FROM (VALUES {", ".join(f"('{name}')" for _, name in _MARKERS)}) c(category) LEFT JOIN
(SELECT {_ROUTE_SQL} AS category FROM (SELECT {_FILE_NAME} AS name FROM part)) f
ON f.category = c.category GROUP BY c.category""")
def q_route_files(spark, sf_dir):
    return count_routed(table(spark, sf_dir, "part").selectExpr(f"{_FILE_NAME} AS name"))


_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)"""
_NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
_LINKS_SQL = f"""SELECT page_id, url, i - 1 AS position,
replace(replace(replace(replace(replace(trim(l[i], '"'''), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
'&#39;', ''''), '&amp;', '&') AS href
FROM (SELECT page_id, url, l, unnest(generate_series(1, len(l))) AS i FROM
(SELECT page_id, url, regexp_extract_all(regexp_replace(html, '{_NOT_MARKUP}', '', 'g'),
'{_HREF}', 1) AS l FROM pages))"""


@query(f"SELECT page_id, CAST(position AS INTEGER) AS position, href FROM ({_LINKS_SQL}) "
       "WHERE href LIKE '%e'")
def q_extract_links(spark, sf_dir):
    return pages.extract_links(table(spark, sf_dir, "pages"), "e", "html", "page_id")


_VARIED = """CASE position % 7 WHEN 1 THEN 'http://other.example.org' || href
WHEN 2 THEN substr(href, 2) WHEN 3 THEN '../' || substr(href, 2) WHEN 4 THEN '//cdn.example.org' || href
WHEN 5 THEN '?q=1' WHEN 6 THEN '#x' ELSE href END"""


@query(f"""SELECT page_id, CAST(position AS INTEGER) AS position, CASE position % 7 WHEN 1 THEN v
WHEN 2 THEN origin || folder || v
WHEN 3 THEN origin || regexp_replace(folder, '[^/]+/$', '') || substr(v, 4)
WHEN 4 THEN regexp_extract(url, '^[a-z]+:') || v WHEN 5 THEN origin || path || v
WHEN 6 THEN origin || path || regexp_extract(url, '\\?[^#]*') || v ELSE origin || v END AS target
FROM (SELECT *, regexp_extract(path, '^.*/') AS folder FROM (SELECT page_id, position, url,
{_VARIED} AS v, regexp_extract(url, '^[a-z]+://[^/]+') AS origin,
regexp_extract(url, '^[a-z]+://[^/]+([^?#]*)', 1) AS path FROM ({_LINKS_SQL})))""")
def q_resolve_links(spark, sf_dir):
    links = pages.extract_links(table(spark, sf_dir, "pages"), "", "html", "page_id", "url")
    varied = links.selectExpr("page_id", "position", "url", f"{_VARIED} AS href")
    return varied.select(
        "page_id", "position", pages.resolve(F.col("url"), F.col("href")).alias("target")
    )


def _listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    found = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("name"),
                                                 F.octet_length("html").alias("size"))
    remote = found.selectExpr("name", "CASE WHEN page_id % 11 = 0 THEN NULL ELSE size END AS size",
                              "page_id % 13 <> 0 AS readable")
    local = found.filter("page_id % 5 <> 0").selectExpr(
        "name", "CASE WHEN page_id % 7 = 0 THEN size + 1 WHEN page_id % 22 = 0 THEN 0 ELSE size END AS size"
    )
    return remote, local


_DIFF_SQL = """SELECT r.name, CASE WHEN NOT r.readable THEN 'changed' WHEN l.name IS NULL THEN 'new'
WHEN coalesce(r.size, 0) <> l.size THEN 'changed' ELSE 'unchanged' END AS status
FROM (SELECT url AS name, page_id % 13 <> 0 AS readable,
CASE WHEN page_id % 11 = 0 THEN NULL ELSE strlen(html) END AS size FROM pages) r
LEFT JOIN (SELECT url AS name, CASE WHEN page_id % 7 = 0 THEN strlen(html) + 1
WHEN page_id % 22 = 0 THEN 0 ELSE strlen(html) END AS size FROM pages WHERE page_id % 5 <> 0) l
ON l.name = r.name"""


@query(_DIFF_SQL)
def q_manifest_diff(spark, sf_dir):
    return manifest.diff(*_listings(spark, sf_dir)).select("name", "status")


@query(f"SELECT name, status FROM ({_DIFF_SQL}) WHERE status <> 'unchanged'")
def q_incremental_pick(spark, sf_dir):
    return manifest.to_load(*_listings(spark, sf_dir)).select("name", "status")


@query("SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type")
def q_stream_files(spark, sf_dir):
    """Two drains with one checkpoint: the second finds nothing new."""
    folder = workspace(spark, "stream")
    for _ in range(2):
        events = stream.new_parquet(spark, f"{sf_dir.rstrip('/')}/events*.parquet")
        stream.drain(events.select("event_id", "event_type"), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").groupBy("event_type").agg(F.count("*").alias("n"))


# -- sinks --------------------------------------------------------------------------

def _amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(15,2)").alias("total")
    )


def _summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).agg(
        F.count("*").alias("n"), F.sum("total").cast("decimal(25,2)").alias("total")
    )


_SUMMARY_SQL = """SELECT {k} * COUNT(*) AS n,
CAST({k} * SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS total FROM orders"""


@query(_SUMMARY_SQL.format(k=2))
def q_write_append(spark, sf_dir):
    path = workspace(spark, "append")
    for _ in range(2):
        sink.append(_amounts(spark, sf_dir), path)
    return _summary(spark, path)


@query(_SUMMARY_SQL.format(k=1))
def q_write_overwrite(spark, sf_dir):
    """The whole table twice, then one snapshot of it twice: never doubled."""
    path = workspace(spark, "overwrite")
    for _ in range(2):
        sink.overwrite(_amounts(spark, sf_dir), path)
    path = workspace(spark, "replace")
    for _ in range(2):
        sink.replace_snapshot(_amounts(spark, sf_dir), path, "2025-10")
    return _summary(spark, path)


@query("""SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(15,2)) AS total
FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1998-10'""")
def q_snapshot_pick(spark, sf_dir):
    path = workspace(spark, "snapshots")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(15,2)").alias("total"),
        snapshot_of(F.date_format("o_orderdate", "'data/'yyyy-MM'/'")).alias(sink.SNAPSHOT),
    )
    sink.write_snapshots(orders, path)
    schema = orders.drop(sink.SNAPSHOT).schema
    return sink.read_snapshots(spark, path, schema, "1998-10").drop(sink.SNAPSHOT)


@query("""SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3""")
def q_layout_lookup(spark, sf_dir):
    path = workspace(spark, "layout")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    layout.cluster(customer, path, ["c_nationkey"], ["c_mktsegment"], bloom=["c_nationkey"])
    found = spark.read.schema(customer.schema).parquet(path)
    return found.filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") == 3))


# -- the whole load -------------------------------------------------------------------

_RAW_REGISTRY: dict[str, tuple[str, str, dict[str, str]]] = {
    # registry table: (given table, raw folder, cells that are not empty)
    "empresa": ("customer", "K1.EMPRECSV", {
        "cnpj_basico": "lpad(CAST(c_custkey AS STRING), 12, '0')",
        "razao_social": "c_name || '; \"Ltda\"'",
        "natureza_juridica": "CAST(c_nationkey AS STRING)",
        "qualificacao_responsavel": "'49'",
        "capital_social": "CASE WHEN c_custkey % 101 = 0 THEN '99999999999999,00' ELSE "
                          "replace(CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS STRING), '.', ',') END",
        "porte_empresa": "'05'",
    }),
    "estabelecimento": ("orders", "K1.ESTABELE", {
        "cnpj_basico": "lpad(CAST(o_custkey AS STRING), 12, '0')",
        "cnpj_ordem": "'0001'",
        "cnpj_dv": "'91'",
        "identificador_matriz_filial": "'1'",
        "nome_fantasia": "o_orderpriority",
        "situacao_cadastral": "'02'",
        "data_situacao_cadastral": "date_format(o_orderdate, 'yyyyMMdd')",
        "cnae_fiscal_principal": "CAST(o_orderkey % 100 AS STRING)",
        "cep": "CASE WHEN o_orderkey % 103 = 0 THEN '061220000' ELSE '06122000' END",
        "uf": "'SP'",
        "municipio": "CAST(o_custkey % 5 AS STRING)",
    }),
    "socios": ("lineitem", "K1.SOCIOCSV", {
        "cnpj_basico": "lpad(CAST(l_orderkey AS STRING), 12, '0')",
        "identificador_socio": "CASE WHEN l_orderkey % 107 = 0 THEN 'dois' ELSE '2' END",
        "nome_socio_razao_social": "'S ' || CAST(l_suppkey AS STRING)",
        "data_entrada_sociedade": "date_format(l_shipdate, 'yyyyMMdd')",
        "faixa_etaria": "CAST(l_linenumber AS STRING)",
    }),
    "simples": ("supplier", "K1.SIMPLES.CSV", {
        "cnpj_basico": "lpad(CAST(s_suppkey AS STRING), 12, '0')",
        "opcao_simples": "CASE WHEN s_suppkey % 9 = 0 THEN 'SIM' ELSE 'S' END",
        "data_opcao_simples": "'20070701'",
        "opcao_mei": "'N'",
    }),
    "pais": ("nation", "K1.PAISCSV", {
        "codigo": "lpad(CAST(n_nationkey AS STRING), 3, '0')", "nome": "n_name",
    }),
    "munic": ("region", "K1.MUNICCSV", {
        "codigo": "lpad(CAST(r_regionkey AS STRING), 4, '0')", "nome": "r_name",
    }),
    "cnae": ("part", "K1.CNAECSV", {
        "codigo": "CASE WHEN p_partkey % 50 = 0 THEN 'sem' ELSE CAST(p_partkey AS STRING) END",
        "nome": "p_name",
    }),
}

_REJECTS = {
    "empresa": "c_custkey % 101 = 0", "estabelecimento": "o_orderkey % 103 = 0",
    "socios": "l_orderkey % 107 = 0", "simples": "s_suppkey % 9 = 0", "cnae": "p_partkey % 50 = 0",
}


def raw_registry(spark: SparkSession, sf_dir: str, folder: str, *names: str, where: str = "true") -> None:
    """Registry files in the published layout, filled from the given tables.  Each is a
    folder of part files, below a folder that is named like another table."""
    for name in names or _RAW_REGISTRY:
        source, target, cells = _RAW_REGISTRY[name]
        row = [f"{cells.get(c, chr(39) * 2)} AS {c}" for c in REGISTRY[name].columns]
        rows = table(spark, sf_dir, source).filter(where).selectExpr(*row)
        write_delimited(rows, f"{folder}/SOCIOS-{name}/{target}")


def write_nothing(spark: SparkSession, path: str) -> None:
    """A file without a byte, through Spark's own file systems."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.create(target, True).close()


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) FILTER (WHERE NOT ({fault})) AS n_accepted, "
    f"COUNT(*) FILTER (WHERE {fault}) AS n_rejected FROM {source}"
    for name, (source, _, _) in _RAW_REGISTRY.items()
    for fault in [_REJECTS.get(name, "false")]
) + " UNION ALL SELECT 'moti', 0, 0 UNION ALL SELECT 'quals', 0, 0")
def q_load_snapshot(spark, sf_dir):
    """Raw folder to tables and quarantine; the same month twice changes nothing, but that
    a list whose file has become empty loses its rows."""
    folder = workspace(spark, "load")
    raw_registry(spark, sf_dir, f"{folder}/raw")
    write_nothing(spark, f"{folder}/raw/K1.MOTICSV")
    quals = f"{folder}/raw/K1.QUALSCSV"
    table(spark, sf_dir, "region").selectExpr("concat(r_regionkey, ';', r_name)").coalesce(1).write.text(quals)
    load.load_snapshot(spark, f"{folder}/raw", f"{folder}/tables", "2025-10")
    table(spark, sf_dir, "region").limit(0).selectExpr("r_name").write.mode("overwrite").text(quals)
    write_nothing(spark, f"{quals}/part-00000.txt")
    load.load_snapshot(spark, f"{folder}/raw", f"{folder}/tables", "2025-10")

    def counts(t: Table) -> DataFrame:
        both = [
            load.read_table(spark, f"{folder}/tables", t, "2025-10").select(F.lit(True).alias("ok")),
            load.read_rejects(spark, f"{folder}/tables", t, "2025-10").select(F.lit(False).alias("ok")),
        ]
        return both[0].unionAll(both[1]).agg(
            F.count_if("ok").alias("n_accepted"), F.count_if(~F.col("ok")).alias("n_rejected")
        ).select(F.lit(t.name).alias("table_name"), "n_accepted", "n_rejected")

    parts = [counts(REGISTRY[name]) for name in (*_RAW_REGISTRY, "moti", "quals")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


@query("""SELECT CAST(k AS INTEGER) AS codigo, 'codigo:duplicate_key' AS reason, COUNT(*) - 1 AS n
FROM (SELECT p_size AS k FROM part) GROUP BY k HAVING COUNT(*) > 1""")
def q_load_keys(spark, sf_dir):
    """Of the rows of a code list with the same code, spelled alike or not, one is kept."""
    folder = workspace(spark, "keys")
    rows = table(spark, sf_dir, "part").selectExpr(
        "CASE WHEN p_partkey % 2 = 0 THEN lpad(CAST(p_size AS STRING), 4, '0') "
        "ELSE CAST(p_size AS STRING) END AS codigo", "p_name AS nome",
    )
    write_delimited(rows, f"{folder}/raw/K1.PAISCSV")
    load.load_snapshot(spark, f"{folder}/raw", f"{folder}/tables", "2025-10")
    rejects = load.read_rejects(spark, f"{folder}/tables", REGISTRY["pais"], "2025-10")
    kept = load.read_table(spark, f"{folder}/tables", REGISTRY["pais"], "2025-10").select("codigo")
    why = rejects.select(F.col("raw.codigo").cast("int").alias("codigo"), F.explode("reasons").alias("reason"))
    return why.join(kept, "codigo").groupBy("codigo", "reason").agg(F.count("*").alias("n"))


def _typed_sql(name: str) -> str:
    """All columns of a loaded table: the raw cells, cleaned by the comparison's formulas."""
    source, _, cells = _RAW_REGISTRY[name]
    raw = ", ".join(
        f"{cells.get(c, chr(39) * 2)} AS {c}".replace("date_format", "strftime").replace("yyyyMMdd", "%Y%m%d")
        for c in REGISTRY[name].columns
    )
    return (f"SELECT {dirty.sql_typed(REGISTRY[name])} FROM "
            f"(SELECT {raw} FROM {source} WHERE NOT ({_REJECTS.get(name, 'false')}))")


def _loaded(name: str):
    def load_one(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = workspace(spark, name)
        raw_registry(spark, sf_dir, f"{folder}/raw", name)
        load.load_snapshot(spark, f"{folder}/raw", f"{folder}/tables", "2025-10")
        found = load.read_table(spark, f"{folder}/tables", REGISTRY[name], "2025-10")
        return found.drop(sink.SNAPSHOT)

    load_one.__name__ = f"q_load_{name}"
    load_one.__doc__ = f"Every value of {name} after a whole load."
    return load_one


for _name in ("empresa", "estabelecimento", "socios", "simples"):
    query(_typed_sql(_name))(_loaded(_name))


@query("""SELECT 'munic' AS table_name, 'second' AS run, COUNT(*) AS n FROM region
UNION ALL SELECT 'pais', 'first', COUNT(*) FILTER (WHERE n_nationkey % 2 = 0) FROM nation
UNION ALL SELECT 'pais', 'second', COUNT(*) FROM nation
UNION ALL SELECT 'simples', 'first', COUNT(*) FILTER (WHERE s_suppkey % 9 <> 0) FROM supplier""")
def q_load_changed(spark, sf_dir):
    """Only tables with new or changed files are loaded again; a third run finds none."""
    folder = workspace(spark, "changed")
    raw, out = f"{folder}/raw", f"{folder}/tables"

    def run(label: str) -> list[tuple[str, str]]:
        return [(name, label) for name in publish.load_changed(spark, raw, out, "2025-10").counts]

    raw_registry(spark, sf_dir, raw, "pais", where="n_nationkey % 2 = 0")
    raw_registry(spark, sf_dir, raw, "simples")
    ran = run("first")
    first = publish.read_table(spark, out, REGISTRY["pais"], "2025-10").count()
    raw_registry(spark, sf_dir, raw, "pais")
    raw_registry(spark, sf_dir, raw, "munic")
    ran += run("second") + run("third")
    parts = [
        publish.read_table(spark, out, REGISTRY[name], "2025-10").agg(F.count("*").alias("now")).select(
            F.lit(name).alias("table_name"), F.lit(label).alias("run"),
            F.when(F.lit((name, label) == ("pais", "first")), F.lit(first)).otherwise(F.col("now"))
            .cast("bigint").alias("n"),
        )
        for name, label in sorted(ran)
    ]
    out_rows = parts[0]
    for part in parts[1:]:
        out_rows = out_rows.unionAll(part)
    return out_rows


@query("""SELECT lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS cnpj_basico, o_orderpriority AS nome_fantasia,
c_name || '; Ltda' AS razao_social FROM orders JOIN customer ON c_custkey = o_custkey
WHERE o_orderkey % 103 <> 0 AND c_custkey % 101 <> 0""")
def q_bucketed_join(spark, sf_dir):
    """Both big tables are laid out by their join key as the load's last step; the join
    of the two needs no shuffle."""
    folder = workspace(spark, "bucketed")
    raw_registry(spark, sf_dir, f"{folder}/raw", "empresa", "estabelecimento")
    database = "rollbook_" + folder.rsplit("-", 1)[-1]
    for month in ("2025-09", "2025-10"):  # side by side
        done = publish.load_changed(
            spark, f"{folder}/raw", f"{folder}/tables", month, database=database, buckets=8
        )
    branches, companies = (
        spark.table(done.catalog[n]).filter(F.col(sink.SNAPSHOT) == "2025-10") for n in ("estabelecimento", "empresa")
    )
    return branches.select("cnpj_basico", "nome_fantasia").join(
        companies.select("cnpj_basico", "razao_social"), "cnpj_basico"
    )
