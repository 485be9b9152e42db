"""The operators by category and key; what they take is read from their code.

``inputs`` is the number of tables an operator takes ("many" for two or more),
the parameters are all others of its function, with their types and defaults.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass

from ..operators import aggregates, cleaning, joins, sorting, validation, windows


@dataclass(frozen=True)
class Operator:
    function: Callable
    name: str
    inputs: int | str = 1
    described_by: Callable | None = None

    @property
    def _described(self) -> Callable:
        return self.described_by or self.function

    @property
    def description(self) -> str:
        return (inspect.getdoc(self._described) or "").split("\n")[0]

    @property
    def parameters(self) -> dict[str, dict]:
        """Name -> type, whether it is required, and else its default."""
        tables = 1 if self.inputs == "many" else self.inputs
        given = list(inspect.signature(self._described).parameters.values())[tables:]
        return {
            p.name: {"type": str(p.annotation), "required": p.default is p.empty}
            | ({} if p.default is p.empty else {"default": p.default})
            for p in given
        }


def _union(*tables, **parameters):
    return joins.union_tables(tables, **parameters)


OPERATORS: dict[str, dict[str, Operator]] = {}


def register(category: str, key: str, operator: Operator) -> None:
    """Add any function from DataFrames to a DataFrame as an operator."""
    OPERATORS.setdefault(category, {})[key] = operator


# Categories and keys by which step lists name the operators.
_KEYS = {
    "Data Cleaning": [
        ("remove_nulls", cleaning.remove_nulls),
        ("fill_nulls", cleaning.fill_nulls),
        ("remove_duplicates", cleaning.remove_duplicates),
        ("convert_types", cleaning.convert_types),
        ("remove_outliers", cleaning.remove_outliers),
        ("flag_outliers", cleaning.flag_outliers),
        ("standardize_text", cleaning.standardize_text),
        ("filter", cleaning.filter_rows),
        ("sort", sorting.sort_rows),
    ],
    "Aggregations": [
        ("group_by", aggregates.group_by),
        ("window_functions", windows.window_functions),
        ("pivot", aggregates.pivot),
        ("statistical_analysis", aggregates.statistics),
        ("rolling_aggregation", windows.rolling_aggregation),
    ],
    "Joins & Integration": [
        ("join", joins.join_tables),
        ("union", joins.union_tables),
        ("lookup", joins.lookup),
        ("cross_join", joins.cross_join),
        ("data_validation", validation.validate),
    ],
}


def _tables(function: Callable) -> int:
    kinds = [p.annotation for p in inspect.signature(function).parameters.values()]
    return sum(kind == "DataFrame" for kind in kinds)


for _category, _listed in _KEYS.items():
    for _key, _function in _listed:
        _name = "Validate" if _function is validation.validate else _key.replace("_", " ").capitalize()
        if _function is joins.union_tables:
            register(_category, _key, Operator(_union, _name, "many", _function))
        else:
            register(_category, _key, Operator(_function, _name, _tables(_function)))


def find(key: str, category: str | None = None) -> Operator:
    """The operator with this key, in one category or in any."""
    for name, operators in OPERATORS.items():
        if key in operators and category in (None, name):
            return operators[key]
    raise ValueError(f"unknown operator: {key}")
