"""Text predicates of the search queries."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

CI_AI = "UNICODE_CI_AI"  # case and accent blind
CI_AI_RTRIM = "UNICODE_CI_AI_RTRIM"  # trailing spaces do not count either


def like_any(c: Column, parts: Iterable[str], ci_ai: bool = False) -> Column:
    """``c LIKE '%a%' OR c LIKE '%b%' ...``; binary unless ``ci_ai``.

    The binary form is a plain substring test, so it reaches the Parquet scan.
    LIKE does not work over ICU collations, ``contains`` does.
    """
    if ci_ai:
        c = F.collate(c, CI_AI)
    return reduce(or_, [c.contains(F.lit(p)) for p in parts])


def same_text(c: Column, value: str, ci_ai: bool = False) -> Column:
    return (F.collate(c, CI_AI_RTRIM) if ci_ai else c) == F.lit(value)
