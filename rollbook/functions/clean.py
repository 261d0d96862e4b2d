"""Text cells to typed values, as Column expressions.

Nothing here raises on a bad cell: a value that does not parse becomes NULL,
and ``rollbook.operators.quality`` says which ones did.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values ---------------------------------------------------------------
NULL_TOKENS = ("", "NULL", "null")  # compared before any trimming
EMPTY_WORDS = ("nan", "None", "")  # compared after quotes are gone
NBSP = "\u00a0"
QUOTE = '"'
# Everything a Unicode-aware strip takes off the ends of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# -----------------------------------------------------------------------------

WHOLE_NUMBER = r"^-?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity)$"
INT_DIGITS = 10  # 2147483647
LONG_DIGITS = 19  # 9223372036854775807


def _drop(c: Column, *words: str) -> Column:
    # nullif binds its operand once; the equivalent CASE WHEN would evaluate the
    # whole cleaning chain a second time for every test (3x slower when timed).
    for word in words:
        c = F.nullif(c, F.lit(word))
    return c


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def without_quotes(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit(QUOTE), F.lit("")), F.lit(NBSP), F.lit(""))


def null_token(c: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Raw cells that spell "missing" become NULL; ' NULL ' and 'NA' stay."""
    return F.when(~c.isin(*tokens), c)


def clean_string(c: Column) -> Column:
    """Trim, drop quotes and no-break spaces, map empty words to NULL, trim again."""
    return _drop(strip(_drop(without_quotes(strip(c)), *EMPTY_WORDS)), "")


def text_core(c: Column) -> Column:
    """First half of ``clean_string`` for projections in two steps: the text that
    is left at the end, before empty words are looked at."""
    return strip(without_quotes(c))


def finish_text(core: Column, raw: Column) -> Column:
    """Second half: give ``core`` as a plain column, so that testing it is free.

    An empty word counts only if it was there before the last trim ('" nan "'
    stays text); that is looked up in the raw cell, and only for such words.
    """
    word = core.isin("nan", "None") & (without_quotes(strip(raw)) == core)
    return F.when((core != "") & ~word, core)


def _spelled(c: Column, as_type: str | T.DataType = "int") -> Column:
    """Text that spells a whole number, as that number.

    A failing ``try_cast`` to a whole number throws and catches an exception inside
    (about 15 microseconds a cell when timed), so text that cannot succeed is made
    NULL first.
    """
    is_int = as_type == "int" or isinstance(as_type, T.IntegerType)
    most = INT_DIGITS if is_int else LONG_DIGITS
    found = F.regexp_extract(c, rf"^[+-]?0*[0-9]{{1,{most}}}$", 0)
    return _drop(found, "").try_cast(as_type)


def _digits_only(c: Column) -> Column:
    """Nearly: letters a to f pass too.  Far cheaper than a pattern, and only used
    to choose the cells that a plain cast is tried on."""
    return F.unhex(c).isNotNull()


def _plain(c: Column, as_type: str | T.DataType = "int") -> Column:
    """Cells of bare digits that are sure to fit; others are NULL and tried no further."""
    is_int = as_type == "int" or isinstance(as_type, T.IntegerType)
    sure = F.octet_length(c) < (INT_DIGITS if is_int else LONG_DIGITS)
    return F.when(sure & _digits_only(c), c.try_cast(as_type))


def to_whole(c: Column, as_type: str | T.DataType = "int") -> Column:
    """Text as a whole number, NULL where it is none; ``c`` should be a plain column."""
    return F.coalesce(_plain(c, as_type), _spelled(c, as_type))


def int_text(c: Column) -> Column:
    """The digits and minus signs of a cell.  Quotes, blanks and the empty words
    hold neither, so no separate text cleaning is needed first."""
    return F.regexp_replace(c, r"[^0-9\-]", "")


def clean_int(c: Column) -> Column:
    """Cells of bare digits, nearly all in practice, skip the patterns: where the
    plain cast works it gives the same number."""
    return F.coalesce(_plain(c), _spelled(int_text(c)))


def code_text(c: Column) -> Column:
    """Int-cleaned, kept as text: '05' -> '5'."""
    return clean_int(c).cast("string")


def assign_int(c: Column) -> Column:
    """What storing cleaned text into an INT column does."""
    return _spelled(clean_string(c))


def decimal_text(c: Column, thousands: str = ".", decimal: str = ",") -> Column:
    # One pass: the decimal mark is mapped to '.', the rest of the set is dropped.
    drop = QUOTE + NBSP + thousands
    return strip(F.translate(c, decimal + drop, "."))


def clean_decimal(c: Column, thousands: str = ".", decimal: str = ",") -> Column:
    return decimal_text(c, thousands, decimal).try_cast(T.DecimalType(15, 2))


def clean_date(c: Column) -> Column:
    """Exactly eight digits once everything else is gone, read as yyyyMMdd.

    A cell of just eight digits is cut up directly (with a letter among them the
    result does not parse).  Otherwise any text without eight digits is rewritten
    to '--', which does not parse either; that keeps the digits from being
    computed twice for a length test.  There is no year 0000.
    """
    bare = (F.octet_length(c) == 8) & _digits_only(c) & (c >= "0001")
    cut = F.concat(
        F.substring(c, 1, 4), F.lit("-"), F.substring(c, 5, 2), F.lit("-"), F.substring(c, 7, 2)
    )
    digits = F.regexp_replace(c, "[^0-9]", "")
    iso = F.regexp_replace(digits, r"^(?!0000)(\d{4})(\d{2})(\d{2})$|^.*$", "$1-$2-$3")
    return F.coalesce(F.when(bare, cut.try_cast("date")), iso.try_cast("date"))


def normalise(field: T.StructField) -> Column:
    """One value, by its declared type: NaN and blank text to NULL, time to date."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        c = F.nanvl(c, F.lit(None).cast(field.dataType))
    elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        c = c.cast("date")
    elif isinstance(field.dataType, T.StringType):
        c = _drop(strip(c), "")
    return c.alias(field.name)
