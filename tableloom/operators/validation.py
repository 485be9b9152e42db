"""Rule-based validation."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import FORMAT_PATTERNS, quoted

VALID = "is_valid_record"


def validate(
    df: DataFrame,
    validation_rules: Mapping[str, str | Column],
    null_as: bool | None = None,
) -> DataFrame:
    """Add ``is_<rule>`` for every rule (SQL or a Column) and ``is_valid_record`` for all.

    A rule over NULL is NULL, and the overall flag is the three-valued AND;
    ``null_as`` replaces NULL results. Rules may use the flags of rules before.
    """
    if not validation_rules:
        return df
    waiting: dict[str, Column] = {}
    for rule, condition in validation_rules.items():
        # Only a rule that names a flag needs it to be there; the rest go together.
        if any(name in str(condition) for name in waiting):
            df, waiting = df.withColumns(waiting), {}
        flag = F.expr(condition) if isinstance(condition, str) else condition
        waiting[f"is_{rule}"] = flag if null_as is None else F.coalesce(flag, F.lit(null_as))
    df = df.withColumns(waiting)
    return df.withColumn(VALID, reduce(and_, [quoted(f"is_{rule}") for rule in validation_rules]))


def format_rules(formats: Mapping[str, str]) -> dict[str, Column]:
    """Rules that check columns against known formats (column -> format name)."""
    unknown = sorted(set(formats.values()) - set(FORMAT_PATTERNS))
    if unknown:
        raise ValueError(f"unknown formats: {', '.join(unknown)}")
    return {
        f"{column}_{name}": quoted(column).rlike(FORMAT_PATTERNS[name])
        for column, name in formats.items()
    }


def split_valid(
    df: DataFrame, validation_rules: Mapping[str, str | Column]
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows); an undecided rule rejects the row."""
    checked = validate(df, validation_rules, null_as=False)
    return checked.filter(F.col(VALID)), checked.filter(~F.col(VALID))
