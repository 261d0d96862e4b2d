"""Registered queries: predicates, joins and searches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.functions.match import like_any
from rollbook.operators import quality, relate
from rollbook.plans import search
from rollbook.plans.registered import query, table
from rollbook.schema import REGISTRY, Link

PRIORITIES = ("URGENT", "HIGH", "LOW")
CITY = "ASIA"

# The given tables under the registry's names: orders are branches, customers companies
# and regions cities.
_REGISTRY_VIEWS = {
    "estabelecimento": ("orders", {
        "cnpj_basico": "lpad(CAST(o_custkey AS STRING), 12, '0')",
        "cnpj_ordem": "lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0')",
        "cnpj_dv": "lpad(CAST(o_orderkey % 97 AS STRING), 2, '0')",
        "nome_fantasia": "o_orderpriority",
        "situacao_cadastral": "CAST(o_orderkey % 8 AS INT)",
        "logradouro": "o_orderstatus",
        "numero": "CAST(o_orderkey AS STRING)",
        "cep": "lpad(CAST(o_orderkey AS STRING), 8, '0')",
        "uf": "'SP'",
        "municipio": "CAST(o_custkey % 5 AS INT)",
        "ddd_1": "CAST(o_orderkey % 90 + 10 AS STRING)",
    }),
    "empresa": ("customer", {
        "cnpj_basico": "lpad(CAST(c_custkey AS STRING), 12, '0')",
        "razao_social": "c_name",
        "porte_empresa": "CAST(c_nationkey % 6 AS INT)",
    }),
    "munic": ("region", {"codigo": "r_regionkey", "nome": "r_name"}),
}


def registry(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The given tables with all columns of the registry's; those not filled are null."""
    out = {}
    for name, (source, cells) in _REGISTRY_VIEWS.items():
        columns = [
            F.expr(cells.get(f.name, "NULL")).cast(f.data_type).alias(f.name) for f in REGISTRY[name].fields
        ]
        out[name] = table(spark, sf_dir, source).select(*columns)
    return out


def _cell(name: str, column: str) -> str:
    return _REGISTRY_VIEWS[name][1].get(column, "CAST(NULL AS VARCHAR)")


_SEARCH_SQL = f"""FROM orders JOIN customer ON c_custkey = o_custkey
JOIN region ON r_regionkey = o_custkey % 5
WHERE ({" OR ".join(f"o_orderpriority LIKE '%{p}%'" for p in PRIORITIES)}) AND r_name = '{CITY}'"""


@query(f"SELECT {_cell('estabelecimento', 'cnpj_basico')} AS cnpj_basico {_SEARCH_SQL}")
def q_flagship(spark, sf_dir):
    t = registry(spark, sf_dir)
    return search.branch_search(t["estabelecimento"], t["empresa"], t["munic"], PRIORITIES, CITY)


@query(f"SELECT COUNT(*) AS n {_SEARCH_SQL}")
def q_count_rows(spark, sf_dir):
    t = registry(spark, sf_dir)
    found = search.branch_search(t["estabelecimento"], t["empresa"], t["munic"], PRIORITIES, CITY)
    return quality.count_rows(found)


@query("SELECT " + ", ".join(
    f"{_cell('empresa' if c in ('razao_social', 'porte_empresa') else 'estabelecimento', c)} AS {c}"
    for c in search.REPORT_COLUMNS
) + f", r_name AS nome_municipio {_SEARCH_SQL} AND {_cell('estabelecimento', 'cep')} LIKE '%12%'")
def q_report(spark, sf_dir):
    t = registry(spark, sf_dir)
    return search.branch_report(
        t["estabelecimento"], t["empresa"], t["munic"], PRIORITIES, CITY, postcode="12"
    )


@query("""SELECT p_partkey, p_name FROM part
WHERE p_name LIKE '%ring%' OR p_name LIKE '%bolt%' OR p_name LIKE '%gear%'""")
def q_like_any(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.filter(like_any(F.col("p_name"), ("ring", "bolt", "gear"))).select("p_partkey", "p_name")


@query("SELECT doc_id FROM documents WHERE contains(strip_accents(lower(text)), 'etre')")
def q_match_ci_ai(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.filter(like_any(F.col("text"), ("ETRE",), ci_ai=True)).select("doc_id")


@query("SELECT o_orderkey, c_custkey, c_name, c_mktsegment FROM orders "
       "INNER JOIN customer ON o_custkey = c_custkey")
def q_join_inner(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return relate.join_facts(orders, customer, "c_custkey").select(
        "o_orderkey", "c_custkey", "c_name", "c_mktsegment"
    )


_SHIFTED = "CASE WHEN c_custkey % 7 = 0 THEN c_nationkey + 20 ELSE c_nationkey END"


@query(f"""SELECT c_custkey, nation_code, n_name AS nation, r_name AS region
FROM (SELECT c_custkey, {_SHIFTED} AS nation_code FROM customer)
LEFT JOIN nation ON n_nationkey = nation_code LEFT JOIN region ON r_regionkey = n_regionkey""")
def q_enrich(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey", f"{_SHIFTED} AS nation_code")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    named = relate.decode(customer, nation, "nation_code", "nation", "n_nationkey", "n_name")
    coded = relate.decode(named, nation, "nation_code", "region_code", "n_nationkey", "n_regionkey")
    return relate.decode(coded, region, "region_code", "region", "r_regionkey", "r_name").select(
        "c_custkey", "nation_code", "nation", "region"
    )


@query("""SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, COUNT(*) AS n
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey
LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey GROUP BY cn.n_name, sn.n_name""")
def q_role_dims(spark, sf_dir):
    """One list in two roles.  Codes are counted first; names go on the few counts."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nation = table(spark, sf_dir, "nation")
    placed = relate.join_list(orders, customer, "o_custkey").select("l_orderkey", "c_nationkey")
    supplied = relate.join_list(items, supplier, "l_suppkey").select("l_orderkey", "s_nationkey")
    codes = (
        relate.join_facts(supplied, placed, "l_orderkey", "left")
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.count("*").alias("n"))
    )
    named = relate.decode(codes, nation, "c_nationkey", "customer_nation", "n_nationkey", "n_name")
    named = relate.decode(named, nation, "s_nationkey", "supplier_nation", "n_nationkey", "n_name")
    return named.groupBy("customer_nation", "supplier_nation").agg(F.sum("n").alias("n"))


@query("""SELECT c_mktsegment, COUNT(*) AS n_rows, COUNT(o_orderkey) AS n_with_order,
COUNT(l_linenumber) AS n_with_item FROM customer LEFT JOIN orders ON o_custkey = c_custkey
LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag <> 'N') ON l_orderkey = o_orderkey
GROUP BY c_mktsegment""")
def q_fanout(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    items = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") != "N").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber"
    )
    filled = relate.fan_out(orders, items, "o_orderkey")
    rows = relate.fan_out(customer, filled, "c_custkey")
    return rows.groupBy("c_mktsegment").agg(
        F.count("*").alias("n_rows"),
        F.count("o_orderkey").alias("n_with_order"),
        F.count("l_linenumber").alias("n_with_item"),
    )


@query("""SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders
WHERE o_custkey = c_custkey AND o_orderpriority LIKE '%URGENT%')""")
def q_semi(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter(like_any(F.col("o_orderpriority"), ("URGENT",)))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return relate.having(customer, urgent.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


_PART_REF = "CASE WHEN l_partkey % 50 = 0 THEN l_partkey + 1000000000000 ELSE l_partkey END"
_NATION_REF = "CASE WHEN c_custkey % 9 = 0 THEN CAST(NULL AS INTEGER) ELSE c_nationkey + 1 END"


@query(f"""WITH refs AS (
SELECT 'lineitem.part_ref' AS link, {_PART_REF} AS k FROM lineitem
UNION ALL SELECT 'orders.o_custkey', o_custkey FROM orders
UNION ALL SELECT 'customer.nation_ref', {_NATION_REF} FROM customer),
lost AS (
SELECT * FROM refs WHERE link = 'lineitem.part_ref' AND k IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = k)
UNION ALL SELECT * FROM refs WHERE link = 'orders.o_custkey' AND k IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = k)
UNION ALL SELECT * FROM refs WHERE link = 'customer.nation_ref' AND k IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = k))
SELECT l.link, COUNT(DISTINCT k) AS n_keys, COUNT(k) AS n_rows
FROM (SELECT DISTINCT link FROM refs) l LEFT JOIN lost ON lost.link = l.link GROUP BY l.link""")
def q_orphans(spark, sf_dir):
    names = ("lineitem", "orders", "customer", "part", "nation")
    tables = {name: table(spark, sf_dir, name) for name in names}
    tables["lineitem"] = tables["lineitem"].selectExpr(f"{_PART_REF} AS part_ref")
    tables["customer"] = tables["customer"].selectExpr("c_custkey", f"{_NATION_REF} AS nation_ref")
    return quality.check_links(tables, [
        Link("lineitem", "part_ref", "part", "p_partkey"),
        Link("orders", "o_custkey", "customer", "c_custkey"),
        Link("customer", "nation_ref", "nation", "n_nationkey"),
    ])


@query("""SELECT lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS cnpj_basico, CAST(o_custkey % 5 AS INTEGER) AS municipio,
r_name AS municipio_nome FROM orders LEFT JOIN region ON r_regionkey = o_custkey % 5""")
def q_decode_all(spark, sf_dir):
    """All codes of a table that have a list, by the declared links."""
    decoded = relate.decode_all(registry(spark, sf_dir), "estabelecimento")
    return decoded.select("cnpj_basico", "municipio", "municipio_nome")


@query("""SELECT l_orderkey, l_linenumber, o_orderdate FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderpriority LIKE '%URGENT%' AND o_custkey % 50 = 7""")
def q_key_filter(spark, sf_dir):
    """A few orders with their items: of the items only those of a Bloom filter of the orders' keys
    are shuffled, whatever their size here."""
    orders = table(spark, sf_dir, "orders").filter(like_any(F.col("o_orderpriority"), ("URGENT",)))
    found = orders.filter("o_custkey % 50 = 7").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    joined = relate.join_selected(found, items, "l_orderkey", least_bytes=0)
    return joined.select("l_orderkey", "l_linenumber", "o_orderdate")
