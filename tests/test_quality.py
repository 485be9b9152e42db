import pytest

from tableloom.operators import quality as q
from tableloom.operators.aggregates import (
    distinct_counts,
    group_by,
    group_by_time,
    pivot,
    row_count,
    statistics,
)
from tableloom.operators.sorting import head, sort_rows, top_k


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0), (1, "a", 1.0), (2, None, -0.0), (3, "b", 0.0), (4, None, None)],
        "k int, s string, x double",
    )


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "k int, s string")


def test_null_profile(table, empty):
    got = [tuple(r) for r in q.null_profile(table).collect()]
    assert got == [("s", 2, 40.0), ("x", 1, 20.0)]
    assert q.null_profile(table, only_nulls=False).count() == 3
    assert [r.null_percentage for r in q.null_profile(empty, False).collect()] == [None, None]


@pytest.mark.parametrize("approximate", [False, True])
def test_column_profile(table, approximate):
    got = {r.column: r for r in q.column_profile(table, approximate).collect()}
    assert got["k"].distinct_count == 4 and got["k"].completeness == 100.0
    # NULL is one distinct value; zero and minus zero are equal.
    assert got["s"].distinct_count == 3 and got["s"].null_count == 2
    assert got["x"].distinct_count == 3 and got["x"].uniqueness == 60.0


def test_table_profile(table, empty):
    row = q.table_profile(table).first()
    assert (row.total_rows, row.total_columns, row.total_nulls) == (5, 3, 3)
    assert (row.completeness, row.null_percentage) == (80.0, 20.0)
    assert row.estimated_mb == 5 * 3 * 8 / 2**20
    none = q.table_profile(empty).first()
    assert (none.total_rows, none.completeness, none.null_percentage) == (0, None, 0.0)


def test_duplicates(table, empty):
    assert tuple(q.duplicate_rows(table).first()) == (5, 1, 20.0)
    assert tuple(q.duplicate_rows(empty).first()) == (0, 0, None)


def test_assess(table):
    row = q.assess(table).first()
    assert (row.total_rows, row.total_columns, row.duplicate_count) == (5, 3, 1)
    assert [tuple(c) for c in row.null_analysis] == [("s", 2, 40.0), ("x", 1, 20.0)]
    assert row.data_types == {"int": 1, "string": 1, "double": 1}
    types = {r.data_type: r.columns for r in q.type_distribution(table).collect()}
    assert types == row.data_types


def test_overviews(table, empty):
    rows = {r.dataset: r for r in q.quality_overview({"t": table, "e": empty}).collect()}
    assert rows["t"].null_percentage_1 == 40.0 and rows["t"].null_percentage_3 == 0.0
    assert rows["e"].total_rows == 0 and rows["e"].null_percentage_1 == 0.0
    shares = {r.dataset: r.completeness for r in q.completeness_overview({"t": table, "e": empty}).collect()}
    assert shares == {"t": 80.0, "e": None}


def test_schema_samples(spark):
    df = spark.createDataFrame([(i, None if i == 2 else "x" * 40, i == 1) for i in (1, 2, 3, 4)], "a int, b string, c boolean")
    got = {r.column: r for r in q.schema_samples(sort_rows(df, ["a"])).collect()}
    assert got["a"].sample_values == "1, 2, 3" and got["a"].position == 1
    assert got["b"].sample_values == ("x" * 40 + ", " + "x" * 40)[:50] + "..."
    assert got["c"].data_type == "boolean"


def test_dataset_info(table):
    info = q.dataset_info(table, 2)
    assert tuple(info["shape"].first()) == (5, 3)
    assert info["schema"].count() == 3 and info["preview"].count() == 2


def test_one_pass_profile(table):
    plan = q.null_profile(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1


def test_group_by(table):
    row = group_by(table, [], {"x": ["sum", "count", "mean"], "k": "max"}).first()
    assert row.asDict() == {"x_sum": 2.0, "x_count": 4, "x_avg": 0.5, "k_max": 4}
    with pytest.raises(ValueError, match="median"):
        group_by(table, ["k"], {"x": "median"})
    with pytest.raises(ValueError):
        group_by(table, ["k"], {})


def test_pivot(spark):
    df = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 3), (1, "a", 4), (2, None, 5)], "g int, p string, v int"
    )
    wide = pivot(df, ["g"], "p", "v")
    assert wide.columns == ["g", "a", "b", "null"]
    assert sorted(tuple(r) for r in wide.collect()) == [(1, 7, 2, None), (2, None, None, 5)]
    counts = pivot(df, ["g"], "p", "v", "count", ["a", "z"])
    assert sorted(tuple(r) for r in counts.collect()) == [(1, 2, None), (2, None, None)]
    with pytest.raises(ValueError):
        pivot(df, ["g"], "p", "v", "median")
    spark.conf.set("spark.sql.pivotMaxValues", "2")
    try:
        with pytest.raises(ValueError, match="more than 2"):
            pivot(df, ["g"], "p", "v")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_statistics_of_a_constant(spark):
    df = spark.createDataFrame([(5,), (5,), (None,)], "x int")
    row = statistics(df, ["x", "unknown"]).first()
    assert (row["count"], row.mean, row.stddev, row.median) == (2, 5.0, 0.0, 5.0)
    assert row.skewness is None and row.kurtosis is None
    assert statistics(df, ["x"], exact=True).first().q3 == 5.0
    with pytest.raises(ValueError):
        statistics(df, ["unknown"])


def test_time_buckets(spark):
    df = spark.sql("SELECT timestamp'2024-02-29 23:00:00' AS t, 2 AS v UNION ALL SELECT timestamp'2024-02-01', 3")
    assert group_by_time(df, "t", "month", {"v": "sum"}).first().v_sum == 5
    assert group_by_time(df, "t", "day", {"v": "sum"}).count() == 2
    with pytest.raises(ValueError):
        group_by_time(df, "t", "fortnight", {"v": "sum"})


def test_counts_and_order(table):
    assert distinct_counts(table, ["k", "s"]).first().asDict() == {"k_distinct": 4, "s_distinct": 2}
    assert row_count(table).first()[0] == 5
    assert [r.k for r in sort_rows(table, [("k", "desc")]).collect()] == [4, 3, 2, 1, 1]
    assert [r.k for r in top_k(table, [("k", "desc")], 2).collect()] == [4, 3]
    assert head(table, 2).count() == 2
    with pytest.raises(ValueError):
        sort_rows(table, [("k", "down")])
