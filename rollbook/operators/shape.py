"""From text columns to declared types, in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions import clean
from rollbook.schema import ASSIGNED, CODE, DATE, INTEGER, MONEY, TEXT, Field, Table
from rollbook.sources.delimited import LONG_RECORD

CLEANERS = {
    TEXT: clean.clean_string,
    INTEGER: clean.clean_int,
    ASSIGNED: clean.assign_int,
    CODE: clean.code_text,
    MONEY: clean.clean_decimal,
    DATE: clean.clean_date,
}

RAW = "raw"
REASONS = "reasons"
REJECTED = "rejected"


def present(df: DataFrame, table: Table) -> list[Field]:
    """The table's fields that the input has; absent ones are skipped."""
    have = set(df.columns)
    return [f for f in table.fields if f.name in have]


def typed_cell(field: Field, raw: Column | None = None) -> Column:
    """One cell on its own; ``typed`` does whole rows faster."""
    c = F.col(field.name) if raw is None else raw
    return CLEANERS[field.kind](c).alias(field.name)


def _raw(field: Field) -> str:
    return f"__raw_{field.name}"


def _core(field: Field) -> str:
    return f"__core_{field.name}"


def _is_text(field: Field) -> bool:
    return field.kind in (TEXT, ASSIGNED)


def _text(field: Field) -> Column:
    return clean.finish_text(F.col(_core(field)), F.col(_raw(field)))


def _cores(raw: DataFrame, fields: list[Field], *keep: str) -> DataFrame:
    """Raw cells under other names, and the trimmed text of text-like ones.

    Texts are worked out in this step and tested in the next one: a projection
    that uses a costly column more than once is not merged into its input.
    """
    return raw.select(
        *[F.col(f.name).alias(_raw(f)) for f in fields],
        *[clean.text_core(F.col(f.name)).alias(_core(f)) for f in fields if _is_text(f)],
        *keep,
    )


def _value(field: Field) -> Column:
    if field.kind == TEXT:
        return _text(field).alias(field.name)
    if field.kind == ASSIGNED:
        return clean.to_whole(_text(field)).alias(field.name)
    return typed_cell(field, F.col(_raw(field)))


def typed(raw: DataFrame, table: Table, *keep: str | Column) -> DataFrame:
    """Clean and cast every declared column; ``keep`` columns pass through."""
    fields = present(raw, table)
    kept = raw.select(*keep).columns
    return _cores(raw, fields, *keep).select(*[_value(f) for f in fields], *kept)


def reject_reason(field: Field, is_key: bool) -> Column | None:
    """NULL for a good cell, else 'column:reason'.

    Only what a relational store would refuse is a reason.  A cell without any
    usable digits is tolerated and simply becomes NULL.
    """
    name, raw, value = field.name, F.col(_raw(field)), F.col(field.name)
    lost = value.isNull() & raw.isNotNull()
    why = None
    if field.kind in (INTEGER, CODE):
        too_big = lost & clean.int_text(raw).rlike(clean.WHOLE_NUMBER)
        why = F.when(too_big, F.lit(f"{name}:int_range"))
    elif field.kind == ASSIGNED:
        why = F.when(lost & _text(field).isNotNull(), F.lit(f"{name}:not_int"))
    elif field.kind == MONEY:
        number = lost & clean.decimal_text(raw).rlike(clean.NUMBER)
        why = F.when(number, F.lit(f"{name}:decimal_range"))
    elif field.kind == TEXT and field.limit:
        # A text never has more characters than bytes, and bytes are at hand.
        too_long = (F.octet_length(value) > field.limit) & (F.char_length(value) > field.limit)
        why = F.when(too_long, F.lit(f"{name}:length"))
    if is_key:
        missing = F.when(value.isNull(), F.lit(f"{name}:null_key"))
        why = missing if why is None else F.coalesce(why, missing)
    return why


#: Rows that are rejected anyway are dealt over so many groups where keys are compared, as
#: a third of them may share one key, or none.
SPREAD = 4096


def duplicate_reason(table: Table) -> str:
    return f"{table.primary_key}:duplicate_key"


def is_repeated(table: Table, good: Column, first_by: list[Column]) -> Column:
    """Is this a good row whose key a good row before it has?"""
    spread = F.when(~good, F.pmod(F.xxhash64(*first_by), F.lit(SPREAD)))
    same_key = Window.partitionBy(table.primary_key, spread).orderBy(*first_by)
    return good & (F.row_number().over(same_key) > 1)


def flag_duplicates(checked: DataFrame, table: Table, *keep: str) -> DataFrame:
    """Rows of several loads, their repeated keys flagged anew as one load would: of good
    rows with the same key the first by raw cells, then by ``keep``, stays.  The raw
    cells of all rows are needed."""
    only_repeated = F.coalesce(F.col(REASONS) == F.array(F.lit(duplicate_reason(table))), F.lit(False))
    good = ~F.col(REJECTED) | only_repeated
    first_by = [F.col(RAW)[f.name] for f in table.fields] + [F.col(c) for c in keep]
    again = is_repeated(table, good, first_by)
    flagged = checked.withColumn("__good", good).withColumn("__again", again)
    return flagged.withColumn(
        REASONS, F.when(F.col("__again"), F.array(F.lit(duplicate_reason(table))))
        .when(~F.col("__good"), F.col(REASONS))
    ).withColumn(REJECTED, F.col("__again") | ~F.col("__good")).drop("__good", "__again")


def typed_with_reasons(raw: DataFrame, table: Table, *keep: str, unique: bool = False,
                       keep_raw: bool = False) -> DataFrame:
    """Typed columns plus ``reasons``, ``rejected`` and, for rejected rows only,
    the ``raw`` cells: one pass that feeds both the table and its quarantine.

    ``unique`` also rejects all but one of the good rows with the same primary key: the
    first by raw cells, then by the ``keep`` columns.  ``keep_raw`` gives the raw cells of
    all rows, which ``flag_duplicates`` asks for.
    """
    fields = present(raw, table)
    extra = [LONG_RECORD] if LONG_RECORD in raw.columns else []
    staged = _cores(raw, fields, *keep, *extra).select(
        "*", *[_value(f) for f in fields]
    )
    checks = [reject_reason(f, f.name == table.primary_key) for f in fields]
    checks = [c for c in checks if c is not None]
    if extra:
        checks.append(F.when(F.col(LONG_RECORD).isNotNull(), F.lit("row:too_many_cells")))
    found = F.concat_ws(",", *checks)  # skips the NULLs of good cells
    flagged = staged.withColumn("__found", found)
    if unique and table.primary_key:
        first_by = [F.col(c) for c in (*[_raw(f) for f in fields], *keep)]
        again = is_repeated(table, F.col("__found") == "", first_by)
        flagged = flagged.withColumn("__again", again).withColumn(
            "__found", F.when(F.col("__again"), duplicate_reason(table)).otherwise(F.col("__found"))
        )
    rejected = F.col("__found") != ""
    return flagged.select(
        *[f.name for f in fields],
        *keep,
        *extra,
        F.when(rejected | F.lit(keep_raw), F.struct(*[F.col(_raw(f)).alias(f.name) for f in fields])).alias(RAW),
        F.when(rejected, F.split("__found", ",")).alias(REASONS),
        rejected.alias(REJECTED),
    )


def normalised(df: DataFrame) -> DataFrame:
    """Every column of any DataFrame in its plain form (see ``clean.normalise``)."""
    return df.select(*[clean.normalise(f) for f in df.schema.fields])
