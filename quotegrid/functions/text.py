"""Column functions for feed text: names, decimal commas and dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accented letters and their plain counterparts, position by position.
ACCENTED = "áéíóúàèìòùäëïöüñÁÉÍÓÚÀÈÌÒÙÄËÏÖÜÑ"
PLAIN = "aeiouaeiouaeiounAEIOUAEIOUAEIOUN"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters that count as blanks around a text, and the shape of a number.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def stripped(c) -> Column:
    """Text without blanks of any kind around it."""
    return F.btrim(_col(c), F.lit(BLANKS))


def normalized_name(c) -> Column:
    """Name for comparison: accents off, lower case, no blanks around."""
    return stripped(F.lower(F.translate(_col(c), ACCENTED, PLAIN)))


def column_name(c) -> Column:
    """Text to a column name; the column form of :func:`quotegrid.schema.column_name`."""
    return F.regexp_replace(F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def finite(c) -> Column:
    """NaN and the infinities to NULL: the engine knows one missing value only."""
    x = _col(c)
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def to_number(c) -> Column:
    """Number or text to double; NaN and what is no number become NULL."""
    x = _col(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def decimal_comma(c) -> Column:
    """``'1,659'`` -> 1.659; blank or unreadable text -> NULL.

    The shape is checked first because a cast also takes suffixes such as ``1.5d``.
    """
    text = F.replace(stripped(c), F.lit(","), F.lit("."))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def strict_date(c) -> Column:
    """``YYYY-MM-DD`` (month and day also with one digit) to a date; anything else -> NULL."""
    text = _col(c)
    shape = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    return F.when(shape, F.try_to_timestamp(text, F.lit("yyyy-M-d")).cast("date"))


def api_date(c) -> Column:
    """Date to ``DD-MM-YYYY``."""
    return F.date_format(_col(c), "dd-MM-yyyy")


def next_version(c) -> Column:
    """``v1`` -> ``v2``; missing counts as ``v1``."""
    digits = F.regexp_replace(F.coalesce(_col(c), F.lit("v1")), "^v+", "")
    number = F.when(digits == "", F.lit(1)).otherwise(digits.try_cast("int"))
    return F.concat(F.lit("v"), (number + 1).cast("string"))
