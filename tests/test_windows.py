import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableloom.operators import windows
from tableloom.operators.windows import as_call, rolling_aggregation, window_functions

ALL = {
    "rn": "row_number", "rk": "rank", "dr": "dense_rank", "back": "lag(v, 2)",
    "ahead": ("lead", "v", 3), "total": "sum(v)",
}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def events(spark):
    """One key holds a third of the rows, NULL many; t has many ties."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 9))
    )
    return (
        spark.range(600)
        .select(
            key.alias("k"),
            F.when(F.col("id") % 13 != 0, F.pmod(F.col("id") * 31, F.lit(17))).alias("t"),
            "id",
            F.when(F.col("id") % 5 != 0, F.col("id") % 100).alias("v"),
        )
        .repartition(7)
    )


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("group_rows", [4, 40])
def test_split_groups_equal_whole_groups(events, keys, group_rows):
    order = [("t", "desc"), "id"]
    whole = window_functions(events, keys, order, ALL)
    split = window_functions(events, keys, order, ALL, group_rows=group_rows)
    assert split.dtypes == whole.dtypes
    assert rows(split) == rows(whole)


@pytest.mark.parametrize("group_rows", [8])
def test_ranks_with_ties_larger_than_a_block(events, group_rows):
    ranks = {"rk": "rank", "dr": "dense_rank"}
    for order in (["t"], [F.col("t").desc_nulls_first()]):
        whole = window_functions(events, ["k"], order, ranks)
        split = window_functions(events, ["k"], order, ranks, group_rows=group_rows)
        assert rows(split) == rows(whole)


def test_exact_copies_are_numbered_without_gaps(spark):
    copies = spark.range(300).select(F.lit(1).alias("k"), F.lit(2).alias("t")).repartition(5)
    numbered = window_functions(copies, ["k"], ["t"], {"rn": "row_number", "rk": "rank"}, group_rows=20)
    assert sorted(r.rn for r in numbered.collect()) == list(range(1, 301))
    assert {r.rk for r in numbered.collect()} == {1}


@pytest.mark.parametrize("function", ["avg", "sum", "min", "max", "count"])
@pytest.mark.parametrize("size", [4, 60])
def test_rolling_split(events, function, size):
    arguments = (events, ["k"], ["t", "id"], size, "v", function)
    whole = rolling_aggregation(*arguments)
    split = rolling_aggregation(*arguments, group_rows=25)
    assert split.dtypes == whole.dtypes
    assert rows(split) == rows(whole)


def test_rolling_of_one_row_is_the_column(events):
    rolled = rolling_aggregation(events, ["k"], "id", 1, "v", "max", alias="same")
    assert rolled.filter("NOT same <=> v").count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    data=st.lists(st.tuples(st.integers(0, 1), st.one_of(st.none(), st.integers(0, 4))), min_size=1, max_size=30),
    group_rows=st.integers(1, 6),
)
def test_any_small_table(spark, data, group_rows):
    df = spark.createDataFrame([(k, t, i, i % 4) for i, (k, t) in enumerate(data)], "k int, t int, id int, v int")
    whole = window_functions(df, ["k"], ["t", "id"], ALL)
    assert rows(window_functions(df, ["k"], ["t", "id"], ALL, group_rows=group_rows)) == rows(whole)


def test_function_texts():
    assert as_call("lag( a ,2 )").size == 2 and as_call("lead(a)").size == 1
    for bad in ("median(a)", "lag", "rank(a)", "sum()", "sum(a, 2)", "lag(a, b)"):
        with pytest.raises(ValueError):
            as_call(bad)


def test_arguments(events):
    with pytest.raises(ValueError):
        window_functions(events, ["k"], [])
    with pytest.raises(ValueError):
        window_functions(events, ["k"], ["t"], {"id": "rank"})
    with pytest.raises(ValueError):
        rolling_aggregation(events, ["k"], "id", 3, "v", "median")
    with pytest.raises(ValueError):
        rolling_aggregation(events, ["k"], "id", 0, "v")
    assert window_functions(events, ["k"], ["id"]).columns[-1] == "row_number"
    # A form delivers sizes as floats.
    assert rolling_aggregation(events, ["k"], "id", 3.0, "v").columns[-1] == "rolling_avg_3"


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("group_rows", [100, 500, 3000])
def test_running_sums_of_doubles_do_not_depend_on_splitting(spark, keys, group_rows):
    """Mixed magnitudes, compared bit by bit."""
    numbers = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4)).alias("k"),
        "id",
        F.when(F.col("id") % 11 == 0, None)
        .otherwise(F.sin("id") * F.pow(F.lit(10.0), F.pmod(F.col("id") * 7, F.lit(23)) - 9))
        .alias("v"),
    ).repartition(5)
    calls = {"total": "sum(v)", "rk": "rank", "back": "lag(v)"}
    whole = window_functions(numbers, keys, ["id"], calls)
    split = window_functions(numbers, keys, ["id"], calls, group_rows=group_rows)
    assert split.dtypes == whole.dtypes
    assert rows(split) == rows(whole)


def test_lists_are_read_like_tuples(spark):
    frame = spark.createDataFrame([(1, 1, 5), (1, 2, 7)], "`a.b` int, t int, v int")
    listed = window_functions(frame, ["a.b"], [["t", "desc"]], {"x": ["lag", "v", 1]})
    assert {r["t"]: r["x"] for r in listed.collect()} == {2: None, 1: 7}
    rolled = rolling_aggregation(frame, ["a.b"], ["t", "desc"], 2, "v", "sum")
    assert {r["t"]: r["rolling_sum_2"] for r in rolled.collect()} == {2: 7, 1: 12}


@pytest.mark.parametrize("group_rows", [1_000_000, 100])
def test_long_frames_against_short_ones(spark, monkeypatch, group_rows):
    """Frames longer than groups and pieces; NULL, NaN and text among the values."""
    df = spark.range(900).select(
        "id",
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 7 == 0, None)
        .when(F.col("id") % 101 == 0, float("nan"))
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double"))
        .alias("x"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.hex(F.xxhash64("id"))).alias("t"),
    )
    for column, function, size in (("x", "min", 65), ("x", "max", 130), ("t", "min", 500), ("t", "max", 70)):
        def rolled(limit):
            monkeypatch.setattr(windows, "LONG_FRAME", limit)
            found = windows.rolling_aggregation(df, ["g"], "id", size, column, function, group_rows=group_rows)
            return sorted(map(repr, found.collect()))

        assert rolled(64) == rolled(10_000)


def test_slices_do_not_grow_with_a_low_group_limit(spark, monkeypatch):
    """A slice is a task, whose report goes to the driver; blocks are as small as asked for."""
    from tableloom.operators import windows as w

    parts = []
    write = w.store

    def counted(df, label):
        found = write(df, label)
        if label == "window-slices":
            parts.append(len(found.inputFiles()))
        return found

    monkeypatch.setattr(w, "store", counted)
    monkeypatch.setattr(w, "SLICES", 10, raising=False)
    df = spark.range(300).select((F.col("id") * 7 % 300).alias("v"))
    got = w.window_functions(df, [], ["v"], {"rn": "row_number", "before": "lag(v)"}, group_rows=3)
    assert {(r.v, r.rn, r.before) for r in got.collect()} == {(i, i + 1, i - 1 if i else None) for i in range(300)}
    w.window_functions(df, [], ["v"], {"rk": "rank"}, group_rows=3).collect()
    assert parts and max(parts) <= 10  # 100 before
    assert w._slices(9_000_000, 1_000) == 10 and w._slices(5_000, 1_000) == 5
    assert w._slices(30 * w.GROUP_ROWS, 1_000) == 30 and w._slices(40 * w.GROUP_ROWS, 2 * w.GROUP_ROWS) == 20
