"""Joins, lookup enrichment and unions.

Spark chooses the join strategy from sizes it knows or measures: no side is
broadcast by a hint. Adaptive execution splits a hot key of an inner join on
both sides, but of an outer, semi or anti join only on the side it preserves.
For the other side the operators measure the largest key; a key too large is
known to have a match there, so its rows can take an inner join instead. Nothing is
measured where Spark's own estimate lets it broadcast that side.

With a further condition a hot key need not have a match. Its rows are numbered,
their pairs take an inner join, and rows that no pair names are added.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import OrderSpec, require
from ..functions.groups import GROUP_ROWS, large_groups
from ..functions.sizing import would_broadcast
from ..functions.storage import store
from .cleaning import remove_duplicates

JOIN_TYPES = {
    "inner": "inner",
    "outer": "full",
    "full": "full",
    "left": "left",
    "right": "right",
    "left_semi": "left_semi",
    "left_anti": "left_anti",
}


def join_tables(
    left: DataFrame,
    right: DataFrame,
    join_keys: Sequence[str],
    join_type: str = "inner",
    left_suffix: str = "_left",
    right_suffix: str = "_right",
    condition: str | None = None,
    group_rows: int | None = None,
) -> DataFrame:
    """Equi-join on columns of the same name.

    Every join type returns one (coalesced) column per key, then the left and
    the right columns; names on both sides get the suffixes. Semi and anti
    joins keep the left names. ``condition`` is an extra SQL predicate, over
    the suffixed names, that a pair must satisfy to match. ``group_rows``: rows of
    one key that a task is trusted with; 1 million, unless the side is small.
    """
    if join_type not in JOIN_TYPES:
        raise ValueError(f"unsupported join type: {join_type}")
    how = JOIN_TYPES[join_type]
    keys = list(join_keys)
    if not keys:
        raise ValueError("join_keys must name at least one column")
    require(left, keys)
    require(right, keys)
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    if condition is not None:
        names = (keys, how, shared, left_suffix, right_suffix, condition)
        hot = None if how == "inner" else _hot_keys(left, right, keys, how, group_rows)
        if hot is None:
            return _conditional(left, right, *names)
        return _conditional_split(left, right, hot, *names)
    if how in ("left_semi", "left_anti"):
        return left.join(_key_set(right, keys, group_rows), keys, how)
    left = left.withColumnsRenamed({c: c + left_suffix for c in shared})
    right = right.withColumnsRenamed({c: c + right_suffix for c in shared})
    if how == "inner":
        return left.join(right, keys, "inner")
    if how == "full":
        return _full(left, right, keys, group_rows)
    return _one_sided(left, right, keys, how, group_rows)


def _large(side: DataFrame, keys: list[str], group_rows: int | None) -> DataFrame | None:
    """Large groups of a side that can be broadcast; a small one is not measured unasked."""
    if group_rows is None and would_broadcast(side):
        return None
    return large_groups(side, keys, group_rows or GROUP_ROWS)


def _hot_keys(left, right, keys, how, group_rows) -> DataFrame | None:
    """Keys with too many rows on a side that adaptive execution cannot split."""
    if how == "full":
        found = [large_groups(side, keys, group_rows or GROUP_ROWS) for side in (left, right)]
    else:
        found = [_large(left if how == "right" else right, keys, group_rows)]
    hot = [large.select(*keys).na.drop() for large in found if large is not None]
    return reduce(DataFrame.unionByName, hot).distinct() if hot else None


def _key_set(right: DataFrame, keys: list[str], group_rows: int | None) -> DataFrame:
    """The right keys for a semi or anti join, hot ones only once."""
    narrow = right.select(*keys)
    large = _large(narrow, keys, group_rows)
    if large is None:
        return narrow
    hot = large.select(*keys)
    return narrow.join(hot, keys, "left_anti").unionByName(hot)


def _one_sided(left, right, keys, how, group_rows) -> DataFrame:
    """Left or right outer join, safe against hot keys on the optional side."""
    large = _large(right if how == "left" else left, keys, group_rows)
    if large is None:
        return left.join(right, keys, how)
    hot = large.select(*keys)
    usual = left.join(hot, keys, "left_anti").join(
        right.join(hot, keys, "left_anti"), keys, how
    )
    matched = left.join(hot, keys, "left_semi").join(
        right.join(hot, keys, "left_semi"), keys, "inner"
    )
    # A hot key that is NULL matches nothing: the anti joins keep its rows.
    return usual.unionByName(matched)


def _full(left, right, keys, group_rows) -> DataFrame:
    """Full outer join; adaptive execution cannot split it at all."""
    hot_sides = [
        large.select(*keys)
        for large in (
            large_groups(left, keys, group_rows or GROUP_ROWS),
            large_groups(right, keys, group_rows or GROUP_ROWS),
        )
        if large is not None
    ]
    if not hot_sides:
        return left.join(right, keys, "full")
    hot = reduce(DataFrame.unionByName, hot_sides).distinct().na.drop()
    unmatched_null = [
        side.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))
        for side in (left, right)
    ]
    cold_left, cold_right = (
        side.na.drop(subset=keys).join(hot, keys, "left_anti")
        for side in (left, right)
    )
    hot_left, hot_right = (
        side.join(hot, keys, "left_semi") for side in (left, right)
    )
    # Which hot keys the other side has is a set of at most |hot| keys.
    in_left, in_right = (
        side.select(*keys).distinct() for side in (hot_left, hot_right)
    )
    parts = [
        cold_left.join(cold_right, keys, "full"),
        hot_left.join(hot_right, keys, "inner"),
        hot_left.join(in_right, keys, "left_anti"),
        hot_right.join(in_left, keys, "left_anti"),
        *unmatched_null,
    ]
    columns = parts[0].columns
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), parts
    ).select(*columns)


def _conditional(left, right, keys, how, shared, left_suffix, right_suffix, condition):
    left, right, match = _matched(left, right, keys, shared, left_suffix, right_suffix, condition)
    joined = left.join(right, match, how)
    if how in ("left_semi", "left_anti"):
        return joined.withColumnsRenamed({c + left_suffix: c for c in shared})
    return _one_key(joined, left, right, keys)


def _matched(left, right, keys, shared, left_suffix, right_suffix, condition):
    """Both sides with names of their own, and what a pair must satisfy."""
    other = {k: f"__right_{k}" for k in keys}
    left = left.withColumnsRenamed({c: c + left_suffix for c in shared})
    right = right.withColumnsRenamed({**{c: c + right_suffix for c in shared}, **other})
    match = reduce(lambda a, b: a & b, [F.col(k) == F.col(other[k]) for k in keys])
    return left, right, match & F.expr(condition)


def _one_key(joined, left, right, keys) -> DataFrame:
    return joined.select(
        *[F.coalesce(F.col(k), F.col(f"__right_{k}")).alias(k) for k in keys],
        *[c for c in left.columns if c not in keys and c != _LEFT_ROW],
        *[c for c in right.columns if not c.startswith("__right_")],
    )


_LEFT_ROW, _RIGHT_ROW = "__left_row", "__right_row"


def _conditional_split(
    left, right, hot, keys, how, shared, left_suffix, right_suffix, condition
) -> DataFrame:
    """A conditional outer, semi or anti join whose ``hot`` keys take inner joins."""
    cold = [side.join(hot, keys, "left_anti") for side in (left, right)]
    usual = _conditional(*cold, keys, how, shared, left_suffix, right_suffix, condition)
    numbered = [
        store(side.join(hot, keys, "left_semi").withColumn(name, F.monotonically_increasing_id()), "join-hot")
        for side, name in ((left, _LEFT_ROW), (right, _RIGHT_ROW))
    ]
    # Row numbers have names of their own, so the suffixes stay as they were.
    a, b, match = _matched(*numbered, keys, shared, left_suffix, right_suffix, condition)
    pairs = a.join(b, match, "inner")
    if how in ("left_semi", "left_anti"):
        found = pairs.select(_LEFT_ROW).distinct()
        return usual.unionByName(numbered[0].join(found, _LEFT_ROW, how).drop(_LEFT_ROW)).select(*left.columns)
    pairs = store(pairs, "join-pairs")
    parts = [pairs]
    for side, name, kept in ((a, _LEFT_ROW, ("left", "full")), (b, _RIGHT_ROW, ("right", "full"))):
        if how in kept:
            parts.append(side.join(pairs.select(name).distinct(), name, "left_anti"))
    whole = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return usual.unionByName(_one_key(whole, a, b, keys))


def lookup(
    main: DataFrame,
    lookup_table: DataFrame,
    main_key: str,
    lookup_key: str,
    lookup_columns: Sequence[str] | None = None,
    suffix: str = "_lookup",
    unique_by: Sequence[OrderSpec] | None = None,
    group_rows: int | None = None,
) -> DataFrame:
    """Left-join chosen columns of a lookup table to the main table.

    A lookup key found several times multiplies rows, unless ``unique_by``
    orders the candidates, of which the first is taken. Looked-up columns the
    main table has already get the suffix. No lookup columns, or an empty list,
    means all.
    """
    chosen = lookup_columns or lookup_table.columns
    extra = [c for c in chosen if c != lookup_key]
    if unique_by:
        lookup_table = remove_duplicates(lookup_table, [lookup_key], unique_by)
    picked = lookup_table.select(
        F.col(lookup_key).alias(main_key),
        *[F.col(c).alias(c + suffix if c in main.columns else c) for c in extra],
    )
    if unique_by:
        return main.join(picked, main_key, "left")
    return _one_sided(main, picked, [main_key], "left", group_rows)


def cross_join(
    left: DataFrame, right: DataFrame, condition: str | None = None
) -> DataFrame:
    """Every pair of rows, or the pairs that satisfy the SQL condition.

    Equalities in the condition become an equi-join in Spark's optimizer, so a
    product is only formed where the caller asks for one.
    """
    pairs = left.crossJoin(right)
    return pairs.filter(F.expr(condition)) if condition else pairs


def union_tables(
    tables: Sequence[DataFrame], union_type: str = "union", by_name: bool = False
) -> DataFrame:
    """Stack two or more tables; ``union`` removes duplicates, ``union_all`` not.

    Columns are matched by position, or by name (missing ones become NULL).
    """
    if len(tables) < 2:
        raise ValueError("union needs at least two tables")
    if union_type not in ("union", "union_all"):
        raise ValueError(f"unsupported union type: {union_type}")
    if by_name:
        stacked = reduce(
            lambda a, b: a.unionByName(b, allowMissingColumns=True), tables
        )
    else:
        stacked = reduce(DataFrame.union, tables)
    return stacked.distinct() if union_type == "union" else stacked
