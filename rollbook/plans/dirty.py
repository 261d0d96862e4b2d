"""Dirty text made from the given tables, by expressions that Spark SQL and the
comparison SQL both understand, and the comparison's own cleaning formulas."""

from __future__ import annotations

from rollbook.schema import Field, Table, assigned, code, date, integer, money, text

Exprs = dict[str, str]


def ymd(column: str, spark: bool) -> str:
    return f"date_format({column}, 'yyyyMMdd')" if spark else f"strftime({column}, '%Y%m%d')"


# -- orders as a raw table with every kind of column and every kind of fault ----

ORDERS = Table(
    "orders",
    (
        text("order_code", 14),
        assigned("customer_code"),
        text("status", 1),
        integer("priority"),
        money("total"),
        date("ordered_on"),
        code("clerk"),
    ),
)


def orders(spark: bool) -> Exprs:
    order_code = "lpad(CAST(o_orderkey AS STRING), 12, '0')"
    total = "replace(CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING), '.', ',')"
    day = ymd("o_orderdate", spark)
    return {
        "order_code": f"""CASE WHEN o_orderkey % 11 = 0 THEN ' "' || {order_code} || '" '
            ELSE {order_code} END""",
        "customer_code": """CASE WHEN o_custkey % 97 = 0 THEN 'x12'
            WHEN o_custkey % 53 = 0 THEN 'NULL'
            ELSE lpad(CAST(o_custkey AS STRING), 12, '0') END""",
        "status": """CASE WHEN o_orderkey % 89 = 0 THEN 'FF'
            WHEN o_orderkey % 7 = 0 THEN '"' || o_orderstatus || '"' ELSE o_orderstatus END""",
        "priority": """CASE WHEN o_orderkey % 83 = 0 THEN '3000000000'
            WHEN o_orderkey % 5 = 0 THEN o_orderpriority
            ELSE 'P#' || substr(o_orderpriority, 1, 1) END""",
        "total": f"""CASE WHEN o_orderkey % 79 = 0 THEN '99999999999999,00'
            WHEN o_orderkey % 73 = 0 THEN '1e3' WHEN o_orderkey % 71 = 0 THEN '1,2,3'
            WHEN o_orderkey % 4 = 0 AND length({total}) > 6
            THEN substr({total}, 1, length({total}) - 6) || '.' ||
                 substr({total}, length({total}) - 5, 6)
            ELSE {total} END""",
        "ordered_on": f"""CASE o_orderkey % 13 WHEN 0 THEN '00000000' WHEN 1 THEN '20250230'
            WHEN 2 THEN '2025101' WHEN 3 THEN substr({day}, 1, 4) || '-' || substr({day}, 5, 2)
            || '-' || substr({day}, 7, 2) ELSE {day} END""",
        "clerk": "lpad(CAST(o_custkey % 30 AS STRING), 3, '0')",
    }


# -- customer as a raw file ------------------------------------------------------

CUSTOMER = Table(
    "customer",
    (
        text("customer_code", 14),
        text("name"),
        integer("nation"),
        money("balance"),
        text("segment", 20),
        text("note"),
    ),
)


def customer(line_breaks: bool) -> Exprs:
    breaks = "CASE c_custkey % 3 WHEN 0 THEN chr(10) WHEN 1 THEN chr(13) || chr(10) ELSE chr(13) END"
    note = f"'line one' || {breaks} || 'line two'" if line_breaks else "'NA'"
    return {
        "customer_code": "lpad(CAST(c_custkey AS STRING), 12, '0')",
        "name": """CASE WHEN c_custkey % 3 = 0 THEN c_name || '; "Ação" Ltda' ELSE c_name END""",
        "nation": "CAST(c_nationkey AS STRING)",
        "balance": "replace(CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS STRING), '.', ',')",
        "segment": "' ' || c_mktsegment || ' '",
        "note": f"""CASE c_custkey % 5 WHEN 0 THEN 'ends with ' || chr(92) WHEN 1 THEN 'Ação'
            WHEN 2 THEN 'NULL' WHEN 3 THEN {note} ELSE '' END""",
    }


# -- part names as dirty text ----------------------------------------------------

PART_TEXT = """CASE p_partkey % 8 WHEN 0 THEN '  "' || p_name || '" '
    WHEN 1 THEN replace(p_name, ' ', chr(160)) WHEN 2 THEN 'nan' WHEN 3 THEN 'None'
    WHEN 4 THEN '' WHEN 5 THEN ' " " ' WHEN 6 THEN 'NaN'
    ELSE chr(9) || p_name || chr(13) || chr(10) END"""


def select_list(exprs: Exprs) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in exprs.items())


def columns(exprs: Exprs) -> list[str]:
    return [f"{e} AS {n}" for n, e in exprs.items()]


# -- cleaning, said again in the comparison's SQL --------------------------------

# Fixed values, written out here apart from the cleaner's own: what counts as blank.
_BLANKS = "(" + " || ".join(f"chr({n})" for n in (
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288
)) + ")"


def sql_null_token(x: str) -> str:
    return f"CASE WHEN {x} IN ('', 'NULL', 'null') THEN NULL ELSE {x} END"


def sql_string(x: str) -> str:
    bare = f"""replace(replace(trim({x}, {_BLANKS}), '"', ''), chr(160), '')"""
    kept = f"nullif(nullif(nullif({bare}, 'nan'), 'None'), '')"
    return f"nullif(trim({kept}, {_BLANKS}), '')"


def sql_int(x: str) -> str:
    return f"TRY_CAST(nullif(regexp_replace({sql_string(x)}, '[^0-9\\-]', '', 'g'), '') AS INTEGER)"


def sql_decimal(x: str) -> str:
    return f"TRY_CAST(replace(replace({sql_string(x)}, '.', ''), ',', '.') AS DECIMAL(15,2))"


def sql_date(x: str) -> str:
    digits = f"regexp_replace({sql_string(x)}, '[^0-9]', '', 'g')"
    return f"CASE WHEN length({digits}) = 8 THEN CAST(try_strptime({digits}, '%Y%m%d') AS DATE) END"


def sql_cell(field: Field, x: str) -> str:
    return {
        "text": sql_string,
        "integer": sql_int,
        "assigned": lambda v: f"TRY_CAST({sql_string(v)} AS INTEGER)",
        "code": lambda v: f"CAST({sql_int(v)} AS VARCHAR)",
        "money": sql_decimal,
        "date": sql_date,
    }[field.kind](x)


def sql_typed(table: Table, prefix: str = "") -> str:
    """The typed columns of ``table``, from raw columns of the same names."""
    return ", ".join(
        f"{sql_cell(f, '(' + sql_null_token(prefix + f.name) + ')')} AS {f.name}"
        for f in table.fields
    )
