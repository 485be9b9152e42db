import pytest
from pyspark.sql import functions as F

from tableloom.operators.cleaning import (
    convert_types,
    fill_nulls,
    flag_outliers,
    remove_duplicates,
    remove_nulls,
    remove_outliers,
    standardize_text,
)
from tableloom.operators.quantiles import exact_quantiles
from tableloom.operators.validation import format_rules, split_valid, validate


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame(
        [(1, 1.0, "a"), (2, None, "b"), (3, float("nan"), None), (4, None, None)],
        "id int, x double, s string",
    )


def test_remove_nulls(gaps):
    assert [r.id for r in remove_nulls(gaps).collect()] == [1]
    assert [r.id for r in remove_nulls(gaps, []).collect()] == [1]
    assert [r.id for r in remove_nulls(gaps, ["s"]).collect()] == [1, 2]
    assert [r.id for r in remove_nulls(gaps, ["x", "s"], "all").collect()] == [1, 2]
    assert remove_nulls(gaps, [], "all").count() == 4
    with pytest.raises(ValueError):
        remove_nulls(gaps, how="some")


def test_fill_nulls_by_type(gaps):
    assert rows(fill_nulls(gaps)) == rows(
        gaps.sparkSession.createDataFrame(
            [(1, 1.0, "a"), (2, 0.0, "b"), (3, 0.0, None), (4, 0.0, None)], gaps.schema
        )
    )
    filled = fill_nulls(gaps, {"s": "none"}, default_value=None)
    assert [r.s for r in filled.collect()] == ["a", "b", "none", "none"]
    assert filled.filter("x IS NULL").count() == 2
    assert [r.s for r in fill_nulls(gaps, None, "0").collect()] == ["a", "b", "0", "0"]


def test_deduplicate_is_idempotent(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (2, None)], "k int, v string")
    once = remove_duplicates(df)
    assert rows(once) == [(1, "a"), (1, "b"), (2, None)]
    assert rows(remove_duplicates(once)) == rows(once)
    assert remove_duplicates(df, []).count() == 3
    assert remove_duplicates(df, ["k"]).count() == 2
    assert rows(remove_duplicates(df, ["k"], [("v", "desc")])) == [(1, "b"), (2, None)]


def test_ordered_deduplication_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    plan = remove_duplicates(df, ["k"], ["v"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]


def test_convert_types(spark):
    df = spark.createDataFrame(
        [("1", "3.7", "2024-02-30", 3.9), (" 2 ", "x", "2024-02-29", None)],
        "a string, b string, c string, d double",
    )
    converted = convert_types(
        df, {"a": "int", "b": "int", "c": "date", "d": "int", "missing": "int"}
    )
    assert converted.columns == df.columns
    got = [tuple(str(v) for v in r) for r in converted.collect()]
    assert got == [("1", "3", "None", "3"), ("2", "None", "2024-02-29", "None")]
    with pytest.raises(Exception):
        convert_types(df, {"b": "int"}, strict=True).collect()


def test_standardize_text_order(spark):
    df = spark.createDataFrame([("  Ab-C é!  ",), (None,)], "t string")
    assert standardize_text(df, ["t", "nope"]).first().t == "ab-c é!"
    assert standardize_text(df, ["t"], ["remove_special"]).first().t == "  AbC   "
    assert standardize_text(df, ["t"], ["remove_special", "upper", "trim"]).first().t == "ABC "
    assert standardize_text(df, ["t"], ["upper", "lower"]).first().t == "  ab-c é!  "
    with pytest.raises(ValueError):
        standardize_text(df, ["t"], ["reverse"])


@pytest.mark.parametrize("exact", [False, True])
def test_outliers(spark, exact):
    values = [float(v) for v in range(1, 100)] + [1000.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    kept = remove_outliers(df, ["x", "unknown"], exact=exact)
    assert kept.count() == 99 and kept.agg(F.max("x")).first()[0] == 99.0
    flags = flag_outliers(df, ["x"], exact=exact)
    assert flags.filter("is_outlier_x").count() == 1
    assert flags.filter("is_outlier_x IS NULL").count() == 1
    assert remove_outliers(df, ["unknown"]).count() == 101


def test_fence_ends_are_inside(spark):
    # Quartiles 10 and 20, so the fences are -5 and 35.
    df = spark.createDataFrame([(float(v),) for v in (-5, 10, 12, 15, 18, 20, 35, 36)], "x double")
    kept = sorted(r.x for r in remove_outliers(df, ["x"], exact=True).collect())
    assert kept[0] == -5.0 and kept[-1] == 35.0


@pytest.mark.parametrize("group_rows", [50, 5_000_000])
def test_exact_quantiles_with_a_hot_value(spark, group_rows):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.pmod(F.col("id") * 7919, F.lit(1009)).cast("double")).alias("x")
    )
    data = sorted(r.x for r in df.collect())
    expected = {p: data[max(0, -(-int(p * 1000) * len(data) // 1000) - 1)] for p in (0.0, 0.25, 0.5, 0.75, 1.0)}
    got = {
        r.probability: r.value
        for r in exact_quantiles(df, ["x"], list(expected), group_rows=group_rows).collect()
    }
    assert got == expected


def test_validation_is_three_valued(spark):
    df = spark.createDataFrame([(5, "a@b.co"), (None, "a@b.co"), (None, "bad")], "n int, mail string")
    rules = {"small": "n < 10", **format_rules({"mail": "email"})}
    got = [(r.is_small, r.is_mail_email, r.is_valid_record) for r in validate(df, rules).collect()]
    assert got == [(True, True, True), (None, True, None), (None, False, False)]
    valid, rejected = split_valid(df, rules)
    assert (valid.count(), rejected.count()) == (1, 2)
    assert validate(df, {}).columns == df.columns
    with pytest.raises(ValueError):
        format_rules({"mail": "colour"})


@pytest.mark.parametrize(
    "name,good,bad",
    [
        ("email", "a.b+c@mail.example.org", "a@b"),
        ("phone", "+1 (555) 010-1234", "call me"),
        ("url", "https://example.com/x?y=1", "ftp://example.com"),
        ("iso_date", "2024-01-31", "31.01.2024"),
    ],
)
def test_formats(spark, name, good, bad):
    df = spark.createDataFrame([(good,), (bad,)], "v string")
    flags = [r[1] for r in validate(df, format_rules({"v": name})).collect()]
    assert flags == [True, False]


def test_stateless_operators_accept_streams(spark, tmp_path):
    spark.createDataFrame([(1, " A ", None), (2, None, 3.0)], "k int, s string, x double").write.parquet(
        str(tmp_path / "in")
    )
    stream = spark.readStream.schema("k int, s string, x double").parquet(str(tmp_path / "in"))
    prepared = validate(
        standardize_text(fill_nulls(remove_nulls(stream, ["s"])), ["s"]), {"one": "k = 1"}
    )
    running = (
        prepared.writeStream.format("memory").queryName("prepared").trigger(availableNow=True).start()
    )
    running.awaitTermination(60)
    assert [tuple(r) for r in spark.table("prepared").collect()] == [(1, "a", 0.0, True, True)]


def test_quantile_outside_its_bounds_is_still_found(spark, monkeypatch):
    from tableloom.operators import quantiles as module

    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("x"))

    def wrong(*_):
        return [module._Target("x", 0.5, 500, 700.0, 800.0), module._Target("x", 0.9, 900, 890.0, 910.0)]

    monkeypatch.setattr(module, "_bounded_targets", wrong)
    got = {r.probability: r.value for r in exact_quantiles(df, ["x"], [0.5, 0.9]).collect()}
    assert got == {0.5: 500.0, 0.9: 900.0}


def test_quantiles_of_empty_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    got = [tuple(r) for r in exact_quantiles(df, ["a", "b"], [0.5]).collect()]
    assert got == [("b", 0.5, 1.0)]
    assert exact_quantiles(df, ["a"], [0.5]).count() == 0


def test_column_names_with_dots(spark):
    from tableloom.operators.aggregates import distinct_counts, group_by, statistics
    from tableloom.operators.cleaning import convert_types, remove_nulls, remove_outliers
    from tableloom.operators.quality import assess, duplicate_rows

    frame = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", None)], "`a.b` string, `v.w` double")
    assert remove_nulls(frame, ["v.w"]).count() == remove_nulls(frame).count() == 2
    sums = group_by(frame, ["a.b"], {"v.w": "sum"}).collect()
    assert {r["a.b"]: r["v.w_sum"] for r in sums} == {"x": 4.0, "y": None}
    assert dict(convert_types(frame, {"v.w": "int"}).dtypes)["v.w"] == "int"
    assert statistics(frame, ["v.w"]).first()["mean"] == 2.0
    assert statistics(frame, ["v.w"], exact=True).first()["median"] == 1.0
    assert distinct_counts(frame, ["a.b"]).first()[0] == 2
    assert duplicate_rows(frame).first()["duplicate_count"] == 0
    assert assess(frame).first()["total_rows"] == 3
    for exact in (False, True):
        assert remove_outliers(frame, ["v.w"], exact=exact).count() == 2
