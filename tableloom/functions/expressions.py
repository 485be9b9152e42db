"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_OPERATIONS = ("trim", "lower", "upper", "remove_special")

# Patterns for the format rules.
FORMAT_PATTERNS = {
    "email": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$",
    "phone": r"^\+?[0-9][0-9 ().x-]{5,}[0-9]$",
    "url": r"^https?://[^\s/]+(/\S*)?$",
    "iso_date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
}

OrderSpec = str | tuple[str, str] | Column


def known(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The given columns that ``df`` has, in the given order."""
    present = set(df.columns)
    return [c for c in columns if c in present]


def require(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")


def quoted(name: str) -> Column:
    """The column of this very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_order(spec) -> bool:
    """Whether the pair, a tuple or a list, is one column and its direction."""
    return (
        isinstance(spec, (tuple, list))
        and len(spec) == 2
        and isinstance(spec[0], str)
        and spec[1] in ("asc", "desc")
    )


def sort_column(spec: OrderSpec) -> Column:
    """``"c"``, ``("c", "desc")`` or a sort Column as a sort Column."""
    if isinstance(spec, Column):
        return spec
    if isinstance(spec, str):
        return quoted(spec).asc()
    name, direction = spec
    if direction not in ("asc", "desc"):
        raise ValueError(f"sort direction must be asc or desc, got {direction!r}")
    return quoted(name).desc() if direction == "desc" else quoted(name).asc()


def sort_columns(specs: Sequence[OrderSpec]) -> list[Column]:
    return [sort_column(s) for s in specs]


def tidy_text(column: Column, operations: Sequence[str]) -> Column:
    """Trim, then one case change (lower wins), then drop special characters."""
    unknown = [o for o in operations if o not in TEXT_OPERATIONS]
    if unknown:
        raise ValueError(f"unknown text operations: {', '.join(unknown)}")
    if "trim" in operations:
        column = F.trim(column)
    if "lower" in operations:
        column = F.lower(column)
    elif "upper" in operations:
        column = F.upper(column)
    if "remove_special" in operations:
        column = F.regexp_replace(column, r"[^a-zA-Z0-9\s]+", "")
    return column


def lenient_cast(column: Column, source: T.DataType, target: str) -> Column:
    """Cast where a value that does not fit becomes NULL.

    Text such as ``"3.7"`` becomes 3 for whole-number targets: Spark's
    non-ANSI cast cuts the fraction, ``try_cast`` alone would give NULL.
    """
    whole = target.lower() in (
        "tinyint", "smallint", "int", "integer", "bigint", "long", "short", "byte",
    )
    if whole and isinstance(source, T.StringType):
        cut = F.regexp_replace(column, r"^(\s*[+-]?[0-9]+)\.[0-9]*\s*$", "$1")
        column = F.when(F.instr(column, ".") > 0, cut).otherwise(column)
    return column.try_cast(target)


def value_text(column: Column, data_type: T.DataType) -> Column:
    """Text that is equal exactly when two values of the column are equal."""
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return (column + F.lit(0.0).cast(data_type)).cast("string")
    if isinstance(data_type, T.BinaryType):
        return F.hex(column)
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column)
    return column.cast("string")


def value_digest(column: Column, data_type: T.DataType) -> tuple[Column, Column]:
    """128 bits in two numbers, equal for equal values; NULL is not told from a value."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        column = column + F.lit(0.0).cast(data_type)  # one zero
    elif not isinstance(data_type, _HASHED):
        column = value_text(column, data_type)
    return F.xxhash64(F.lit(1), column), F.xxhash64(F.lit(2), column)


_HASHED = (
    T.StringType, T.BinaryType, T.BooleanType, T.IntegralType, T.DecimalType, T.DateType, T.TimestampType,
    T.TimestampNTZType,
)


def cell_digests(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (``cell``, ``a``, ``b``) per cell: the column's place, the value's digest or NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def cell(place: int, name: str) -> Column:
        a, b = value_digest(quoted(name), types[name])
        known = quoted(name).isNotNull()
        return F.struct(
            F.lit(place).alias("cell"), F.when(known, a).alias("a"), F.when(known, b).alias("b")
        )

    return df.select(F.inline(F.array(*[cell(i, c) for i, c in enumerate(columns)])))
