"""Text and number forms that agree with Python's ``str``, ``str.strip`` and ``float``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that Python's str.strip() removes.
SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_DIGITS = "[0-9](?:_?[0-9])*"
# The decimal literals Python's float() takes (it allows single underscores between digits).
# Spark's own cast is wider: it also takes 1d, 1f and 0x1p3.
NUMBER_PATTERN = (
    rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
)
# The words Python's float() takes.
NUMBER_WORDS = {
    "nan": "nan", "+nan": "nan", "-nan": "nan",
    "inf": "inf", "+inf": "inf", "infinity": "inf", "+infinity": "inf",
    "-inf": "-inf", "-infinity": "-inf",
}

_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"


def column_type(df: DataFrame, name: str) -> T.DataType:
    """Type of a column, found without regard to case as Spark resolves names."""
    for field in df.schema.fields:
        if field.name.lower() == name.lower():
            return field.dataType
    raise KeyError(name)


def find_column(df: DataFrame, name: str) -> str | None:
    """The frame's own spelling of a column name, or ``None`` when it has no such column."""
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def is_numeric(dtype: T.DataType) -> bool:
    """True for the types whose values always count as numbers (booleans are 0 and 1)."""
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def strip(column: Column) -> Column:
    return F.btrim(column, F.lit(SPACE))


def _float_text(column: Column) -> Column:
    """Shortest decimal text of a double, in exponent form only below 1e-4 and from 1e16 on."""
    java = column.cast("string")
    size = F.abs(column)
    plain = F.regexp_replace(java.try_cast("decimal(38,21)").cast("string"), r"(\.[0-9]+?)0+$", "$1")
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    power = F.substring_index(java, "E", -1)
    digits = F.regexp_replace(F.ltrim(power, F.lit("-")), "^([0-9])$", "0$1")
    sign = F.when(power.startswith("-"), F.lit("-")).otherwise(F.lit("+"))
    # Java writes zero and these sizes without an exponent. Told by the number, so that the text is made once.
    short = ((size >= 1e-3) & (size < 1e7)) | (size == 0)
    return (
        F.when(short, java)
        .when(F.isnan(column), F.lit("nan"))
        .when(column == float("inf"), F.lit("inf"))
        .when(column == float("-inf"), F.lit("-inf"))
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.concat(mantissa, F.lit("e"), sign, digits))
    )


def as_text(column: Column, dtype: T.DataType) -> Column:
    """``str(value)`` of a typed column; null stays null."""
    if isinstance(dtype, T.StringType):
        return column
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return _float_text(column)
    if isinstance(dtype, T.BooleanType):
        return F.initcap(column.cast("string"))
    return column.cast("string")


def shown(column: Column, dtype: T.DataType) -> Column:
    """As :func:`as_text`, with null shown as ``None``."""
    return F.coalesce(as_text(column, dtype), F.lit("None"))


def parse_number(text: Column) -> Column:
    """``float(text)`` for text, or null where Python raises ``ValueError``."""
    bare = F.lower(strip(text))
    words = F.create_map(*[part for w, v in NUMBER_WORDS.items() for part in (F.lit(w), F.lit(float(v)))])
    general = F.when(bare.rlike(NUMBER_PATTERN), F.translate(bare, "_", "").try_cast("double")).otherwise(
        F.try_element_at(words, bare)
    )
    # Text of these characters alone is a number for Spark exactly when it is one for Python.
    return F.when(text.rlike("^[0-9.eE+-]+$"), text.try_cast("double")).otherwise(general)


def as_number(column: Column, dtype: T.DataType) -> Column:
    """``float(value)`` of a typed column as double; null where it is no number."""
    if is_numeric(dtype):
        return column.cast("double")
    if isinstance(dtype, T.StringType):
        return parse_number(column)
    return F.lit(None).cast("double")


def title_case(text: Column) -> Column:
    """``str.title()``: a cased letter is upper exactly when no cased letter stands before it."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    general = F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")
    # Where every word begins after a blank, initcap does the same without an array per row.
    plain = text.rlike("^[ -~]*$") & ~text.rlike(r"[!-@\[-`{-~][A-Za-z]")
    return F.when(plain, F.initcap(text)).otherwise(general)
