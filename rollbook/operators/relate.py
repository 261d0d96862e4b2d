"""Joins of facts with code lists and of facts with each other."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.functions.clean import to_whole
from rollbook.operators.keys import key_filter, let_through
from rollbook.schema import LINKS, Link

# In bytes of plan statistics, for a side that every executor gets.  For catalog tables with column
# statistics these are rows times row size; for files they are compressed bytes: a list may
# be some times larger in memory, and the bound allows for that.
BROADCAST_BYTES = 8 << 20

# In bytes of plan statistics, for facts whose shuffle costs more than a second look at a selection.
FILTER_BYTES = 256 << 20


def plan_bytes(df: DataFrame) -> int | None:
    """The optimizer's size of a DataFrame, or None where it is not available."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a side for broadcast only if its size is known and within the limit.

    Beyond it the join stays a shuffled one, whose hot partitions AQE splits.
    """
    size = plan_bytes(df)
    return F.broadcast(df) if size is not None and size <= limit else df


def join_list(fact: DataFrame, codes: DataFrame, on: str | list[str] | Column,
              how: str = "left") -> DataFrame:
    """Fact to code list.  The fact is the preserved side, so a hot or missing
    code can be split even when the list is too big to broadcast."""
    return fact.join(small_side(codes), on, how)


def is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def decode(fact: DataFrame, codes: DataFrame, column: str, into: str,
           key: str = "codigo", name: str = "nome") -> DataFrame:
    """Add the description of one code column; rows without a match stay.

    Call it several times for a list that plays several roles.
    """
    probe = f"__{into}"
    as_type = codes.schema[key].dataType
    value = F.col(column)
    if is_text(fact, column) and not is_text(codes, key):
        value = to_whole(value, as_type)  # a code kept as text
    side = codes.select(F.col(key).alias(probe), F.col(name).alias(into))
    return join_list(fact, side, value == F.col(probe)).drop(probe)


def listed_codes(text: Column, sep: str = ",") -> Column:
    """The codes in a text, blanks left out."""
    return F.filter(F.transform(F.split(text, re.escape(sep)), lambda c: F.trim(c)), lambda c: c != "")


def decode_list(fact: DataFrame, codes: DataFrame, column: str, into: str, key: str = "codigo",
                name: str = "nome", sep: str = ",") -> DataFrame:
    """Add the descriptions of a text that lists codes, as an array in the order of the codes.

    An unknown or unreadable code has a null in its place, a repeated one is repeated, blanks
    between separators are left out; a null text has a null, one of blanks no descriptions.
    Each different text is taken apart and put together once, map-side first, so a text that
    many rows share costs one row, and rows without codes take no part.
    """
    texts = fact.filter(F.col(column).isNotNull()).select(F.col(column).alias("__list")).distinct()
    listed = texts.select("__list", F.posexplode(listed_codes(F.col("__list"), sep)).alias("__at", "__code"))
    kind = codes.schema[key].dataType
    code = F.col("__code") if is_text(codes, key) else to_whole(F.col("__code"), kind)
    side = codes.select(F.col(key).alias("__key"), F.col(name).alias("__name"))
    named = join_list(listed, side, code == F.col("__key"))
    back = named.groupBy("__list").agg(
        F.sort_array(F.collect_list(F.struct("__at", "__name"))).alias("__names")  # one text's codes
    )
    found = fact.join(back, F.col(column) == F.col("__list"), "left")
    names = F.transform("__names", lambda n: n["__name"])
    nothing = F.when(F.col(column).isNotNull(), F.array().cast("array<string>"))
    return found.select(*fact.columns, F.coalesce(names, nothing).alias(into))


def decode_all(tables: Mapping[str, DataFrame], name: str, links: Iterable[Link] = LINKS) -> DataFrame:
    """A table with the description of each of its codes, as ``column_nome``, an array for
    listed codes; links to tables that are not code lists, or not given, are left out."""
    df = tables[name]
    for link in links:
        parent = tables.get(link.parent)
        if link.child == name and parent is not None and "nome" in parent.columns:
            add = decode_list if link.listed else decode
            df = add(df, parent, link.column, f"{link.column}_nome", link.key)
    return df


def join_facts(left: DataFrame, right: DataFrame, on: str | list[str],
               how: str = "inner") -> DataFrame:
    """Fact to fact on a text key, every matching pair.

    Bucketed tables meet without a shuffle.  Otherwise both sides are shuffled
    and AQE splits a hot key of either side (inner) or of the left side (left).
    """
    return left.join(right, on, how)


def join_selected(found: DataFrame, facts: DataFrame, key: str, least_bytes: int = FILTER_BYTES) -> DataFrame:
    """Inner join of a selection with facts it is much smaller than, on one key.

    Facts of ``least_bytes`` or more, by plan statistics, first lose the rows whose key is not in a
    Bloom filter of the selection's keys: the filter has a fixed size and is broadcast, so the
    facts that can match are all that is shuffled.  The selection is read once more for it, which
    costs less than moving the facts.  Smaller facts are joined as they are.
    """
    size = plan_bytes(facts)
    if size is not None and size < least_bytes:
        return join_facts(found, facts, key)
    return join_facts(found, let_through(facts, key, key_filter(found, key)), key)


def fan_out(one: DataFrame, many: DataFrame, on: str | list[str],
            split_hot: bool = False, keys_of: DataFrame | None = None) -> DataFrame:
    """Left join that repeats ``one`` for each of ``many``.

    A left join cannot split a hot key of its right side.  ``split_hot`` says that
    ``many`` has one: the join is then put together from an inner join, which can, and
    the rows without any partner, at the cost of reading both sides twice.  For those
    only the distinct keys of ``many`` are needed, and they combine map-side.  Where
    ``many`` is itself a join, ``keys_of`` names the input that has all its keys.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if not split_hot:
        return one.join(many, keys, "left")
    paired = one.join(many, keys, "inner")
    known = (many if keys_of is None else keys_of).select(*keys).distinct()
    lonely = one.join(known, keys, "left_anti")
    return paired.unionByName(lonely, allowMissingColumns=True)


def having(one: DataFrame, many: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``one`` with at least one partner, once each.

    Distinct first: a hot key of ``many`` is one row before the shuffle.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return one.join(many.select(*keys).distinct(), keys, "left_semi")
