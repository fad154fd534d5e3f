"""Cell normalisers. Every function maps Column to Column and stays inside code generation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Texts that stand for a missing cell, and the replacements for missing business values.
NULL_WORDS = ("None", "nan", "NaT")
STAFF = "Staff"
IN_HOUSE = "Personal_Interno"
TO_BE_DEFINED = "POR DEFINIR"

# Text date layouts in order of preference, each with the shape that admits it.
# The shape keeps two-digit years out, which the bare layout would read as years 0 to 99.
DATE_LAYOUTS = (
    ("yyyy-M-d", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("d/M/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("d-M-yyyy", r"^\d{1,2}-\d{1,2}-\d{4}$"),
    ("yyyy/M/d", r"^\d{4}/\d{1,2}/\d{1,2}$"),
    ("d.M.yyyy", r"^\d{1,2}\.\d{1,2}\.\d{4}$"),
)

ANY_LAYOUT_SHAPE = r"^\d{1,4}[-/.]\d{1,2}[-/.]\d{1,4}$"

DATETIME_LAYOUT = "yyyy-MM-dd HH:mm:ss"
# Shapes are tested before parsing: a failed parse costs far more than a pattern.
DATETIME_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
INTEGER_SHAPE = r"^[+-]?[0-9]+$"
NUMBER_SHAPE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# Decimals by what follows the point: zeros alone, or digits and then zeros.
PLAIN_DECIMAL = r"^([+-]?[0-9]+)(?:\.0*|(\.[0-9]*[1-9])0*)$"
# Numbers that need conversion: more than six decimals, no digit before the point, or an exponent.
OTHER_DECIMAL = r"(?U)^\s*[+-]?([0-9]+\.[0-9]{7,}|\.[0-9]+|[0-9]+(\.[0-9]*)?[eE][+-]?[0-9]+)\s*$"
# Numbers with an exponent, which have to be written out.
EXPONENT = r"(?U)^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)[eE][+-]?[0-9]+\s*$"

# Day zero of spreadsheet serial dates, and the serials of 0001-01-01 and 9999-12-31.
SERIAL_EPOCH = "1899-12-30"
SERIAL_MIN = -693593
SERIAL_MAX = 2958465


def strip(c: Column) -> Column:
    """Trim every kind of whitespace; Spark's plain trim only knows the space character.

    Trimming by a character set is slow, and most cells have nothing to trim: a pattern finds those that do.
    """
    return F.when(c.rlike(r"(?U)^\s|\s\z"), F.btrim(c, F.lit(WHITESPACE))).otherwise(c)


def is_blank(c: Column) -> Column:
    return ~has_text(c)


def has_text(c: Column) -> Column:
    """Not null and not only whitespace; null counts as blank, so the result is never null."""
    return F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def one_line(c: Column) -> Column:
    """Trim, and turn line breaks and runs of whitespace into one space."""
    return F.regexp_replace(strip(c), r"(?U)\s+", " ")


def header_key(c: Column) -> Column:
    """The form under which two headers count as the same column in contract checks."""
    return F.upper(one_line(c))


def looks_numeric(c: Column) -> Column:
    return F.coalesce(c.rlike(NUMBER_SHAPE), F.lit(False))


def null_words_to_null(c: Column, words: Iterable[str] = NULL_WORDS) -> Column:
    return F.when(~c.isin(*words), c)


def error_cell_to_null(c: Column) -> Column:
    return F.when(~c.startswith("#"), c)


def sentinel_to_null(c: Column) -> Column:
    return F.when(~(c.rlike("#N/D|#N/A") | F.lower(c).contains("error")), c)


def staff_default(c: Column) -> Column:
    return F.when(is_blank(c) | (c == "0"), F.lit(STAFF)).otherwise(c)


def empty_default(c: Column, value: str = IN_HOUSE) -> Column:
    """Null or exactly empty text; blanks made of spaces stay."""
    return F.when(c.isNull() | (c == ""), F.lit(value)).otherwise(c)


def null_default(c: Column, value: str = TO_BE_DEFINED) -> Column:
    return F.coalesce(c, F.lit(value))


def strip_dot_zero(c: Column) -> Column:
    return F.regexp_replace(c, r"\.0$", "")


def number_text(c: Column) -> Column:
    """A double as plain text: six decimals at most, no trailing zeros, no lone point, no negative zero."""
    return F.regexp_replace(F.format_string("%f", c + F.lit(0.0)), r"\.?0+$", "")


def number_cell_text(c: Column) -> Column:
    """Canonical text for a cell that holds a fractional number; anything else is trimmed.

    Plain decimals only lose trailing zeros, which needs no number; the rare other forms are converted.
    """
    plain = F.regexp_replace(strip(c), PLAIN_DECIMAL, "$1$2")
    fractional = F.when(c.rlike(OTHER_DECIMAL), number_text(c.try_cast("double"))).otherwise(plain)
    return F.when(c.contains(".") | c.contains("e") | c.contains("E"), fractional).otherwise(strip(c))


def printed_number_text(c: Column) -> Column:
    """As above without rounding: a number keeps all digits it is printed with, less trailing zeros."""
    plain = F.regexp_replace(strip(c), PLAIN_DECIMAL, "$1$2")
    return F.when(c.rlike(EXPONENT), number_text(c.try_cast("double"))).otherwise(plain)


def datetime_text(c: Column) -> Column:
    return F.date_format(c, DATETIME_LAYOUT)


def slash_date_to_datetime_text(c: Column) -> Column:
    """D/M/YYYY text becomes canonical datetime text when it is a real date; other text is only trimmed."""
    text = strip(c)
    parsed = F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(text, "d/M/yyyy"))
    return F.coalesce(datetime_text(parsed), text)


def datetime_text_to_date(c: Column, date_only: bool = False) -> Column:
    """'YYYY-MM-DD HH:MM:SS' to date, anything else to null; ``date_only`` also admits bare dates."""
    value = F.when(c.rlike(DATETIME_SHAPE), F.try_to_timestamp(c, F.lit(DATETIME_LAYOUT)).cast("date"))
    return value.when(c.rlike(DATE_SHAPE), F.try_to_date(c, "yyyy-MM-dd")) if date_only else value


def fractional_datetime_text_to_date(c: Column) -> Column:
    """As above, with optional fractions of a second of any length up to nanoseconds."""
    whole = c.rlike(DATETIME_SHAPE[:-1] + r"(\.\d{1,9})?$")
    return F.when(whole, F.try_to_timestamp(F.substring(c, 1, 19), F.lit(DATETIME_LAYOUT)).cast("date"))


def layout_date(c: Column) -> Column:
    """First of the known text layouts that fits and names a real date."""
    text = strip(c)
    found = F.coalesce(*[F.when(text.rlike(shape), F.try_to_date(text, layout)) for layout, shape in DATE_LAYOUTS])
    return F.when(text.rlike(ANY_LAYOUT_SHAPE), found)


def serial_date(c: Column) -> Column:
    """Spreadsheet serial number (text or numeric, fraction dropped) to date."""
    text = strip(c.cast("string"))
    days = F.when(text.rlike(NUMBER_SHAPE), text.try_cast("double"))
    return F.when(
        days.between(SERIAL_MIN, SERIAL_MAX),
        F.date_add(F.lit(SERIAL_EPOCH).cast("date"), days.try_cast("int")),
    )


def sheet_date(c: Column) -> Column:
    """Date from a raw sheet cell: serial number, datetime text, or one of the text layouts."""
    return F.coalesce(serial_date(c), datetime_text_to_date(c), layout_date(c))
