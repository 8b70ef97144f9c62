"""The named value transforms, as typed column functions, and the registry that holds them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ferrytab.functions.text import as_number, as_text, strip, title_case

# Source status codes and the target statuses they stand for.
STATUS_CODES = {
    "1": "ACTIVE", "A": "ACTIVE",
    "2": "LAPSED", "L": "LAPSED",
    "3": "PAID_UP", "P": "PAID_UP",
    "4": "SURRENDERED", "S": "SURRENDERED",
    "5": "MATURED", "M": "MATURED",
    "6": "DEATH_CLAIM", "D": "DEATH_CLAIM",
    "7": "CANCELLED", "C": "CANCELLED",
}

# Flag spellings and the texts that stand for "no date".
TRUE_FLAGS = ("Y", "YES", "1", "T", "TRUE")
FALSE_FLAGS = ("N", "NO", "0", "F", "FALSE")
NO_DATE = ("", "0", "00000000")

TypedFunction = Callable[[Column, T.DataType], Column]


@dataclass(frozen=True)
class Transform:
    """A named transform: ``build(column, its type)`` gives a column of type ``returns``."""

    name: str
    build: TypedFunction
    returns: T.DataType


def trim_string(column: Column, dtype: T.DataType) -> Column:
    return F.nullif(strip(as_text(column, dtype)), F.lit(""))


def date_to_iso(column: Column, dtype: T.DataType) -> Column:
    text = as_text(column, dtype)
    bare = strip(text)
    packed = F.translate(bare, "-/", "")

    def day(digits: Column) -> Column:
        dashed = F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))
        return dashed.try_cast("date").cast("string")

    # Most values are eight digits or an ISO day as they stand. No calendar day has the year 0000.
    is_day = "^(?!0000)[0-9]{8}$"
    is_iso = "^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}$"
    return (
        F.when(text.rlike(is_day), day(text))
        .when(text.rlike(is_iso), text.try_cast("date").cast("string"))
        .when(text.isNull() | bare.isin(*NO_DATE), F.lit(None))
        .when(packed.rlike(is_day), day(packed))
        .when(F.length(packed) == 8, F.lit(None))
        .otherwise(text)
    )


def decimal_to_double(column: Column, dtype: T.DataType) -> Column:
    return F.round(as_number(column, dtype), 4)


def status_code_map(column: Column, dtype: T.DataType) -> Column:
    code = F.upper(strip(as_text(column, dtype)))
    table = F.create_map(*[F.lit(x) for pair in STATUS_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, code), code)


def name_title_case(column: Column, dtype: T.DataType) -> Column:
    return title_case(strip(as_text(column, dtype)))


def phone_normalize(column: Column, dtype: T.DataType) -> Column:
    digits = F.regexp_replace(as_text(column, dtype), "[^0-9]", "")
    return (
        F.when(F.length(digits) == 10, F.concat(F.lit("+1"), digits))
        .when((F.length(digits) == 11) & digits.startswith("1"), F.concat(F.lit("+"), digits))
        .otherwise(F.nullif(digits, F.lit("")))
    )


def ssn_mask(column: Column, dtype: T.DataType) -> Column:
    digits = F.regexp_replace(as_text(column, dtype), "[^0-9]", "")
    return F.when(F.length(digits) >= 4, F.concat(F.lit("***-**-"), F.right(digits, F.lit(4))))


def null_coalesce(column: Column, dtype: T.DataType, default: str = "") -> Column:
    text = as_text(column, dtype)
    return F.when(text.isNull() | (strip(text) == ""), F.lit(default)).otherwise(text)


def currency_to_cents(column: Column, dtype: T.DataType) -> Column:
    return F.rint(as_number(column, dtype) * 100).try_cast("bigint")


def boolean_from_flag(column: Column, dtype: T.DataType) -> Column:
    flag = F.upper(strip(as_text(column, dtype)))
    return F.when(flag.isin(*TRUE_FLAGS), F.lit(True)).when(flag.isin(*FALSE_FLAGS), F.lit(False))


class TransformRegistry:
    """Named transforms. A new registry holds the ten standard ones."""

    def __init__(self) -> None:
        self._transforms: dict[str, Transform] = {}
        self.register("trim_string", trim_string)
        self.register("db2_date_to_iso", date_to_iso)
        self.register("packed_decimal_to_float", decimal_to_double, "double")
        self.register("status_code_map", status_code_map)
        self.register("name_title_case", name_title_case)
        self.register("phone_normalize", phone_normalize)
        self.register("ssn_mask", ssn_mask)
        self.register("null_coalesce", null_coalesce)
        self.register("currency_to_cents", currency_to_cents, "bigint")
        self.register("boolean_from_flag", boolean_from_flag, "boolean")

    def names(self) -> list[str]:
        return list(self._transforms)

    def register(self, name: str, build: TypedFunction, returns: str = "string") -> None:
        """Add a transform written with Spark column functions."""
        self._transforms[name] = Transform(name, build, T.DataType.fromDDL(returns))

    def register_python(self, name: str, function: Callable, returns: str = "string") -> None:
        """Add a plain Python function of one value; it runs in Arrow batches.

        The function gets the value as Spark holds it (int, Decimal, date, None ...), whatever else is
        in its batch.
        """
        kind = to_arrow_type(T.DataType.fromDDL(returns))

        def values(array):
            import pyarrow as pa

            return pa.array([function(value) for value in array.to_pylist()], kind)

        udf = F.arrow_udf(values, returns)
        self.register(name, lambda column, dtype: udf(column), returns)

    def get(self, name: str) -> Transform:
        if name not in self._transforms:
            raise ValueError(f"Unknown transform: {name}")
        return self._transforms[name]

    def apply(self, name: str, column: Column, dtype: T.DataType = T.StringType(), **options) -> Column:
        """The transformed column. ``options`` go to the transform (``default`` of null_coalesce)."""
        return self.get(name).build(column, dtype, **options)

    def describe(self, name: str, column: Column, dtype: T.DataType = T.StringType(), **options) -> Column:
        """Text ``name(value) → result`` per row, with value and result cut to 50 characters."""
        result = self.apply(name, column, dtype, **options)

        def literal(value: Column, kind: T.DataType) -> Column:
            text = as_text(value, kind)
            if isinstance(kind, T.StringType):
                text = F.concat(F.lit("'"), text, F.lit("'"))
            return F.substring(F.coalesce(text, F.lit("None")), 1, 50)

        return F.concat(
            F.lit(f"{name}("), literal(column, dtype), F.lit(") → "), literal(result, self.get(name).returns)
        )
