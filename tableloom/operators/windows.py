"""Window functions and rolling aggregates that survive very large groups.

Groups of ordinary size use Spark's window operator as it is. A group larger
than ``group_rows`` (or a window without partition columns over a larger table)
would sort in one task, so it is numbered and cut into equal blocks instead:

1. range-partition the rows on (keys, order) - Spark samples the split points -
   and write them once, so that every later step sees the same slices;
2. number the rows by their place in the written slices, adding the sizes of the
   slices before;
3. cut the numbering into blocks; running results are computed per block and
   the totals of the earlier blocks are added, frames that look back or ahead
   get copies of the neighbouring rows.

Ranks alone need no numbering of rows: they come from counts per order value.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import OrderSpec, is_order, quoted, require, sort_columns
from ..functions.groups import GROUP_ROWS, SIZE, attach, large_groups, split_off
from ..functions.storage import store

RANKINGS = ("row_number", "rank", "dense_rank")
ROLLING = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}

_CALL = re.compile(r"\s*(?P<fn>\w+)\s*(\(\s*(?P<arg>\w+)\s*(,\s*(?P<n>\d+)\s*)?\))?\s*$")

SUM_ROWS = 256
"""Rows of a group whose running sum is taken by itself. Part of the arithmetic."""

LONG_FRAME = 64
"""Rows of a frame up to which its least and greatest value are searched row by row."""

SLICES = 500
"""Slices a table is cut into, as long as a slice has no more than ``GROUP_ROWS`` rows."""

_SLICE, _PLACE, _BLOCK, _HALO, _RUN = "__slice", "__place", "__block", "__halo", "__run"


@dataclass(frozen=True)
class Call:
    """One window result: a ranking, an offset, a running sum or a rolling one."""

    kind: str
    column: str | None = None
    size: int = 1

    @property
    def rows_before(self) -> int:
        if self.kind == "lag":
            return self.size
        if self.kind.startswith("rolling_"):
            return self.size - 1
        return 1 if self.kind in ("rank", "dense_rank") else 0

    @property
    def rows_after(self) -> int:
        return self.size if self.kind == "lead" else 0

    @property
    def running(self) -> bool:
        return self.kind in ("rank", "dense_rank", "sum")

    @property
    def long_extreme(self) -> bool:
        return self.kind in ("rolling_min", "rolling_max") and self.size > LONG_FRAME

    def over(self, window) -> Column:
        """The plain Spark form."""
        if self.kind in RANKINGS:
            return getattr(F, self.kind)().over(window)
        if self.kind == "lag":
            return F.lag(quoted(self.column), self.size).over(window)
        if self.kind == "lead":
            return F.lead(quoted(self.column), self.size).over(window)
        if self.kind == "sum":
            return F.sum(quoted(self.column)).over(
                window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            )
        aggregate = ROLLING[self.kind.removeprefix("rolling_")]
        return aggregate(quoted(self.column)).over(window.rowsBetween(1 - self.size, 0))


def as_call(spec: str | tuple) -> Call:
    """``"rank"``, ``"lag(c, 2)"``, ``"sum(c)"`` or the tuple ``("lag", "c", 2)``."""
    if isinstance(spec, (tuple, list)):
        kind, column, size = (*spec, None, None)[:3]
    else:
        match = _CALL.match(spec)
        if match is None:
            raise ValueError(f"cannot read window function {spec!r}")
        kind, column, size = match["fn"], match["arg"], match["n"]
    if kind in RANKINGS and column is None:
        return Call(kind)
    if kind in ("lag", "lead") and column is not None:
        return Call(kind, column, 1 if size is None else int(size))
    if kind == "sum" and column is not None and size is None:
        return Call(kind, column)
    raise ValueError(
        f"unsupported window function {spec!r}; use row_number, rank, dense_rank, "
        "lag(column[, n]), lead(column[, n]) or sum(column)"
    )


def window_functions(
    df: DataFrame,
    partition_columns: Sequence[str] | None = None,
    order_columns: Sequence[OrderSpec] | None = None,
    window_functions: Mapping[str, str | tuple] | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add one column per entry of ``window_functions`` (alias -> function).

    Ascending order puts NULLs first, descending last. Without partition
    columns the whole table is one window.
    """
    calls = {
        alias: as_call(spec)
        for alias, spec in (window_functions or {"row_number": "row_number"}).items()
    }
    if not order_columns:
        raise ValueError("window functions need order_columns")
    return _apply(df, list(partition_columns or []), order_columns, calls, group_rows)


def rolling_aggregation(
    df: DataFrame,
    partition_columns: Sequence[str],
    order_column: OrderSpec | Sequence[OrderSpec],
    window_size: int,
    agg_column: str,
    agg_function: str = "avg",
    alias: str | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Aggregate over the current row and the ``window_size - 1`` rows before it.

    The first rows of a group use the shorter frames they have. The result is
    ``rolling_<function>_<size>`` unless ``alias`` is given.
    """
    if agg_function not in ROLLING:
        raise ValueError(f"unsupported rolling function: {agg_function}")
    size = int(window_size)
    if size < 1:
        raise ValueError("window_size must be at least 1")
    name = alias or f"rolling_{agg_function}_{size}"
    several = isinstance(order_column, list) and not is_order(order_column)
    orders = order_column if several else [order_column]
    calls = {name: Call(f"rolling_{agg_function}", agg_column, size)}
    return _apply(df, list(partition_columns), orders, calls, group_rows)


def _apply(
    df: DataFrame,
    keys: list[str],
    orders: Sequence[OrderSpec],
    calls: Mapping[str, Call],
    group_rows: int,
) -> DataFrame:
    require(df, [*keys, *(c.column for c in calls.values() if c.column)])
    taken = [alias for alias in calls if alias in df.columns]
    if taken:
        raise ValueError(f"columns exist already: {', '.join(taken)}")
    if keys:
        large = large_groups(df, keys, group_rows)
        if large is None:
            return _plain(df, keys, orders, calls)
        small, big = split_off(df, keys, large)
        rows = large.agg(F.sum(SIZE)).first()[0]
        return _plain(small, keys, orders, calls).unionByName(
            _blocked(big, keys, orders, calls, rows, group_rows)
        )
    rows = df.count()
    if rows <= group_rows:
        return _plain(df, keys, orders, calls)
    return _blocked(df, keys, orders, calls, rows, group_rows)


def _inexact(df: DataFrame, call: Call) -> bool:
    """Whether the order of additions shows in the call's result."""
    return call.kind == "sum" and isinstance(
        df.schema[call.column].dataType, (T.FloatType, T.DoubleType)
    )


def _before(*keys: str) -> Window:
    return Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)


def _so_far(*keys: str) -> Window:
    return (
        Window.partitionBy(*keys)
        .orderBy(_PLACE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _added(here: Column, earlier: Column) -> Column:
    return F.coalesce(earlier + here, here, earlier)


def _plain(df, keys, orders, calls) -> DataFrame:
    long = {a: c for a, c in calls.items() if c.long_extreme}
    if long:
        others = {a: c for a, c in calls.items() if a not in long}
        base = _plain(df, keys, orders, others) if others else df
        found = _with_extremes(base, [quoted(k) for k in keys], sort_columns(orders), long)
        return found.select(*[quoted(c) for c in df.columns], *map(quoted, calls))
    window = Window.partitionBy(*map(quoted, keys)).orderBy(*sort_columns(orders))
    sums = {a: c for a, c in calls.items() if _inexact(df, c)}
    rest = {a: c.over(window) for a, c in calls.items() if a not in sums}
    if not sums:
        return df.withColumns(rest)
    # Sums of runs, then the sums of the runs before: see the head of this module.
    columns = [quoted(k) for k in keys]
    placed = df.withColumns({**rest, _PLACE: F.row_number().over(window)})
    placed = placed.withColumn(_RUN, F.floor((F.col(_PLACE) - 1) / SUM_ROWS))
    placed = placed.withColumns(
        {f"__here_{a}": F.sum(quoted(c.column)).over(_so_far(*columns, _RUN)) for a, c in sums.items()}
    )
    ends = F.col(_PLACE) % SUM_ROWS == 0
    placed = placed.withColumns(
        {
            f"__earlier_{a}": F.sum(F.when(ends, F.col(f"__here_{a}"))).over(
                _before(*columns).orderBy(_PLACE)
            )
            for a in sums
        }
    )
    return placed.select(
        *[quoted(c) for c in df.columns],
        *[
            _added(F.col(f"__here_{a}"), F.col(f"__earlier_{a}")).alias(a) if a in sums else quoted(a)
            for a in calls
        ],
    )


def _with_extremes(df, columns: list[Column], order: list[Column], calls) -> DataFrame:
    """``df`` plus rolling least and greatest values, whose cost does not grow with the frame.

    Rows are cut into pieces as long as the frame. A frame is then the end of one
    piece and the start of the next: the least value from its first row to the end
    of that piece, and from the start of the next piece to its last row.
    """
    placed = df.withColumn("__row", F.row_number().over(Window.partitionBy(*columns).orderBy(*order)) - 1)
    by_row = Window.partitionBy(*columns).orderBy("__row")
    for alias, call in calls.items():
        least = call.kind == "rolling_min"
        aggregate, either = (F.min, F.least) if least else (F.max, F.greatest)
        piece = F.floor(F.col("__row") / call.size)
        inside = Window.partitionBy(*columns, piece)
        ahead, back = (
            aggregate(quoted(call.column)).over(inside.orderBy(o).rowsBetween(Window.unboundedPreceding, 0))
            for o in (F.asc("__row"), F.desc("__row"))
        )
        placed = (
            placed.withColumns({"__ahead": ahead, "__back": back})
            .withColumn(alias, either("__ahead", F.lag("__back", call.size - 1).over(by_row)))
            .drop("__ahead", "__back")
        )
    return placed.drop("__row")


def _slices(rows: int, group_rows: int) -> int:
    """How many slices to sort: what each tells the driver must not grow with the rows.

    A low ``group_rows`` cuts blocks, which are groups and no tasks, not slices.
    """
    least = -(-rows // max(group_rows, GROUP_ROWS))
    return max(1, least, min(SLICES, -(-rows // group_rows)))


def _numbered(df, keys, orders, rows, group_rows) -> DataFrame:
    """``df`` plus each row's place (1, 2, ...) in its group, over many tasks."""
    hashable = [
        quoted(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)
    ]
    # Rows equal in the order columns, even exact copies, may be very many.
    # Hash and origin task spread them; both are the same on a re-run.
    spread = df.withColumns(
        {"__hash": F.xxhash64(*hashable), "__origin": F.spark_partition_id()}
    )
    sort = [*[quoted(k).asc() for k in keys], *sort_columns(orders), "__hash", "__origin"]
    slices = _slices(rows, group_rows)
    sliced = store(
        spread.repartitionByRange(slices, *sort)
        .sortWithinPartitions(*sort)
        .withColumn("__at", F.monotonically_increasing_id()),
        "window-slices",
    ).withColumn(_SLICE, F.shiftright("__at", 33))
    group = [_SLICE, *keys]
    columns = [quoted(k) for k in keys]
    # A group's rows lie side by side in a slice; ``__at`` counts them.
    starts = (
        sliced.groupBy(_SLICE, *columns)
        .agg(F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__first"))
        .withColumn(
            "__start", F.coalesce(F.sum("__rows").over(_before(*columns).orderBy(_SLICE)), F.lit(0))
        )
        .drop("__rows")
    )
    return attach(sliced, starts, group).select(
        *[quoted(c) for c in df.columns],
        (F.col("__at") - F.col("__first") + 1 + F.col("__start")).alias(_PLACE),
    )


def _by_values(df, keys, orders, calls, group_rows) -> DataFrame:
    """Ranks from a histogram of the order values: only these are sorted, not the rows.

    Counts per distinct value are cut into slices by value, the slices' sums are
    added up, and every row finds its value's rank by a join.
    """
    names = list(dict.fromkeys([*keys, *(o if isinstance(o, str) else o[0] for o in orders)]))
    sort = [*[quoted(k).asc() for k in keys], *sort_columns(orders)]
    counted = store(df.groupBy(*map(quoted, names)).agg(F.count(F.lit(1)).alias("__rows")), "window-values")
    slices = _slices(counted.count(), group_rows)
    sliced = store(
        counted.repartitionByRange(slices, *sort).withColumn(_SLICE, F.spark_partition_id()), "window-slices"
    )
    columns = [quoted(k) for k in keys]
    here = Window.partitionBy(_SLICE, *columns).orderBy(*sort_columns(orders))
    sums = sliced.groupBy(_SLICE, *columns).agg(F.sum("__rows").alias("__n"), F.count(F.lit(1)).alias("__d"))
    # One row per slice, and per group in it.
    before = _before(*columns).orderBy(_SLICE)
    starts = sums.select(
        _SLICE,
        *columns,
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__earlier_rows"),
        F.coalesce(F.sum("__d").over(before), F.lit(0)).alias("__earlier_values"),
    )
    ranked = attach(
        sliced.withColumns(
            {
                "__below": F.coalesce(
                    F.sum("__rows").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
                ),
                "__turn": F.row_number().over(here),
            }
        ),
        starts,
        [_SLICE, *keys],
    ).select(
        *map(quoted, names),
        (F.col("__below") + F.col("__earlier_rows") + 1).alias("__rank"),
        (F.col("__turn") + F.col("__earlier_values")).alias("__dense"),
    )
    return attach(df, ranked, names).select(
        *[quoted(c) for c in df.columns],
        *[
            F.col("__rank" if c.kind == "rank" else "__dense")
            .cast(_plain_type(df, keys, orders, c))
            .alias(a)
            for a, c in calls.items()
        ],
    )


def _blocked(df, keys, orders, calls, rows, group_rows) -> DataFrame:
    named = all(isinstance(o, str) or is_order(o) for o in orders)
    if named and all(c.kind in ("rank", "dense_rank") for c in calls.values()):
        return _by_values(df, keys, orders, calls, group_rows)
    numbered = _numbered(df, keys, orders, rows, group_rows)
    back = max(c.rows_before for c in calls.values())
    ahead = max(c.rows_after for c in calls.values())
    size = max(group_rows, back, ahead, 1)
    if any(_inexact(df, c) for c in calls.values()):
        size = -(-size // SUM_ROWS) * SUM_ROWS  # runs end where blocks end
    place = F.col(_PLACE) - 1
    home = ((place - place % size) / size).cast("long")
    # A row goes to its own block, and as a halo copy to the next (previous)
    # block when that block's first (last) rows look back (ahead) at it.
    copies = [F.struct(home.alias(_BLOCK), F.lit(False).alias(_HALO))]
    if back:
        copies.append(
            F.when(
                place % size >= size - back,
                F.struct((home + 1).alias(_BLOCK), F.lit(True).alias(_HALO)),
            )
        )
    if ahead:
        copies.append(
            F.when(
                (place % size < ahead) & (home > 0),
                F.struct((home - 1).alias(_BLOCK), F.lit(True).alias(_HALO)),
            )
        )
    spread = numbered.withColumn("__copies", F.array_compact(F.array(*copies)))
    spread = spread.select(
        *[quoted(c) for c in df.columns], _PLACE, F.inline("__copies").alias(_BLOCK, _HALO)
    ).withColumn(_RUN, F.floor((F.col(_PLACE) - 1) / SUM_ROWS))
    names = [quoted(k) for k in keys]
    block = Window.partitionBy(*names, _BLOCK)
    by_place = block.orderBy(_PLACE)
    if any(c.kind in ("rank", "dense_rank") for c in calls.values()):
        # The halo row in front makes the comparison right at block borders.
        spread = spread.withColumn(
            "__peer", F.dense_rank().over(block.orderBy(*sort_columns(orders)))
        ).withColumn(
            "__new",
            F.coalesce(
                F.col("__peer") != F.lag("__peer").over(by_place), F.lit(True)
            ),
        )
    so_far = by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    real = ~F.col(_HALO)
    long = {a: c for a, c in calls.items() if c.long_extreme}
    if long:
        spread = _with_extremes(spread, [*names, F.col(_BLOCK)], [F.asc(_PLACE)], long)
    columns = {}
    for alias, call in calls.items():
        if alias in long:
            columns[alias] = quoted(alias)
        elif call.kind == "row_number":
            columns[alias] = F.col(_PLACE)
        elif call.kind == "rank":
            columns[alias] = F.max(F.when(real & F.col("__new"), F.col(_PLACE))).over(so_far)
        elif call.kind == "dense_rank":
            columns[alias] = F.count(F.when(real & F.col("__new"), 1)).over(so_far)
        elif _inexact(df, call):
            # Runs end with blocks, so a halo row is never in a real row's run.
            columns[alias] = F.sum(quoted(call.column)).over(_so_far(*names, _BLOCK, _RUN))
        elif call.kind == "sum":
            columns[alias] = F.sum(F.when(real, quoted(call.column))).over(so_far)
        else:
            columns[alias] = call.over(by_place)
    local = (
        spread.withColumns(columns)
        .filter(real)
        .select(*[quoted(c) for c in df.columns], _BLOCK, _RUN, _PLACE, *calls)
    )
    result_types = {a: _plain_type(df, keys, orders, c) for a, c in calls.items()}
    if any(c.running for c in calls.values()):
        local = store(local, "window-blocks")
        sums = {a: c for a, c in calls.items() if _inexact(df, c)}
        others = {a: c for a, c in calls.items() if c.running and a not in sums}
        if others:
            local = _add_earlier_blocks(local, keys, others)
        if sums:
            local = _add_earlier_runs(local, keys, sums)
    return local.select(
        *[quoted(c) for c in df.columns], *[F.col(a).cast(t).alias(a) for a, t in result_types.items()]
    )


def _plain_type(df, keys, orders, call) -> T.DataType:
    return _plain(df, keys, orders, {"__result": call}).schema["__result"].dataType


def _add_earlier_runs(local, keys, calls) -> DataFrame:
    """Add to the sums of runs what the runs before them come to, in their order."""
    names = [quoted(k) for k in keys]
    totals = local.groupBy(*names, _RUN).agg(
        *[F.max_by(a, _PLACE).alias(f"__total_{a}") for a in calls]
    )
    carried = totals.select(
        *names,
        _RUN,
        *[
            F.sum(f"__total_{a}").over(_before(*names).orderBy(_RUN)).alias(f"__earlier_{a}")
            for a in calls
        ],
    )
    joined = attach(local, carried, [*keys, _RUN])
    return joined.withColumns(
        {a: _added(F.col(a), F.col(f"__earlier_{a}")) for a in calls}
    ).drop(*[f"__earlier_{a}" for a in calls])


def _add_earlier_blocks(local, keys, calls) -> DataFrame:
    """Add to running results what the blocks before contribute."""
    running = {a: c for a, c in calls.items() if c.running}
    group = [*keys, _BLOCK]
    names = [quoted(k) for k in keys]
    before = _before(*names).orderBy(_BLOCK)
    totals = local.groupBy(*names, _BLOCK).agg(
        *[
            (
                F.max(a)
                if c.kind in ("rank", "dense_rank")
                else F.sum(quoted(c.column))
            ).alias(f"__total_{a}")
            for a, c in running.items()
        ]
    )
    carried = totals.select(
        *names,
        _BLOCK,
        *[
            (F.max if c.kind == "rank" else F.sum)(f"__total_{a}")
            .over(before)
            .alias(f"__before_{a}")
            for a, c in running.items()
        ],
    )

    def combined(alias: str, call: Call) -> Column:
        here, earlier = F.col(alias), F.col(f"__before_{alias}")
        if call.kind == "rank":
            return F.coalesce(here, earlier)
        return F.coalesce(here + earlier, here, earlier)

    return attach(local, carried, group).select(
        *[quoted(c) for c in local.columns if c not in running],
        *[combined(a, c).alias(a) for a, c in running.items()],
    )
