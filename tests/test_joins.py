import pytest
from pyspark.sql import functions as F

from tableloom.operators.joins import cross_join, join_tables, lookup, union_tables

TYPES = ["inner", "outer", "left", "right", "left_semi", "left_anti"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "a", 10), (2, "b", 20), (3, "c", 30), (None, "n", 0)], "k int, name string, v int"
    )


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(
        [(1, 100, 1), (1, 101, 2), (4, 102, 3), (None, 103, 4)], "k int, sale int, v int"
    )


def test_keys_are_coalesced_and_names_suffixed(people, sales):
    joined = join_tables(people, sales, ["k"], "outer")
    assert joined.columns == ["k", "name", "v_left", "sale", "v_right"]
    assert sorted(r.k for r in joined.collect() if r.k is not None) == [1, 1, 2, 3, 4]
    assert joined.filter("k IS NULL").count() == 2
    right = join_tables(people, sales, ["k"], "right", "_p", "_s")
    assert right.columns == ["k", "name", "v_p", "sale", "v_s"]
    assert join_tables(people, sales, ["k"], "left_semi").columns == people.columns


def test_semi_and_anti_split_the_left(people, sales):
    semi = join_tables(people, sales, ["k"], "left_semi")
    anti = join_tables(people, sales, ["k"], "left_anti")
    assert rows(semi.union(anti)) == rows(people)


@pytest.mark.parametrize("how", TYPES)
def test_hot_keys_give_the_same_rows(spark, how):
    """A third of all rows under one key, and many under NULL, on either side."""

    def side(n, name, modulo):
        key = (
            F.when(F.col("id") % 3 == 0, 5)
            .when(F.col("id") % 11 == 0, F.lit(None))
            .otherwise(F.col("id") % modulo)
        )
        return spark.range(n).select(key.alias("k"), (F.col("id") % 2).alias("g"), F.col("id").alias(name))

    left, right = side(300, "l", 60), side(90, "r", 80)
    for keys in (["k"], ["k", "g"]):
        other = right if keys == ["k", "g"] else right.drop("g")
        plain = join_tables(left, other, keys, how)
        split = join_tables(left, other, keys, how, group_rows=15)
        assert split.columns == plain.columns
        assert rows(split) == rows(plain)
        swapped = join_tables(other, left, keys, how, group_rows=15)
        assert rows(swapped) == rows(join_tables(other, left, keys, how))


@pytest.mark.parametrize("how", TYPES)
def test_condition_with_hot_keys(spark, how):
    """A third of all rows under one key; some rows of a hot key match nothing."""

    def side(n, name, modulo):
        key = (
            F.when(F.col("id") % 3 == 0, 5)
            .when(F.col("id") % 11 == 0, F.lit(None))
            .otherwise(F.col("id") % modulo)
        )
        return spark.range(n).select(F.col("id").alias(name), key.alias("k"), (F.col("id") % 7).alias("v"))

    left, right = side(200, "l", 40), side(80, "r", 60)
    for condition in ("v_left > v_right + 3", "l + r < 100", "v_left + v_right > 1000"):
        plain = join_tables(left, right, ["k"], how, condition=condition)
        split = join_tables(left, right, ["k"], how, condition=condition, group_rows=10)
        assert split.columns == plain.columns
        assert rows(split) == rows(plain)


@pytest.mark.parametrize("how", TYPES)
def test_condition(spark, people, sales, how):
    joined = join_tables(people, sales, ["k"], how, condition="sale > 100")
    expected = join_tables(people, sales.filter("sale > 100"), ["k"], how)
    if how in ("outer", "right"):
        assert joined.filter("name IS NOT NULL").count() == expected.filter("name IS NOT NULL").count()
    else:
        assert rows(joined) == rows(expected)
    assert joined.columns == expected.columns


def test_join_arguments(people, sales):
    with pytest.raises(ValueError):
        join_tables(people, sales, ["k"], "sideways")
    with pytest.raises(ValueError):
        join_tables(people, sales, [])
    with pytest.raises(ValueError):
        join_tables(people, sales, ["nope"])


def test_lookup(people, sales):
    found = lookup(sales, people, "k", "k", ["name", "v"])
    assert found.columns == ["k", "sale", "v", "name", "v_lookup"]
    assert found.count() == 4
    best = lookup(people, sales, "k", "k", ["sale"], unique_by=[("sale", "desc")])
    assert rows(best.select("k", "sale")) == rows(
        people.sparkSession.createDataFrame([(1, 101), (2, None), (3, None), (None, None)], "k int, sale int")
    )
    renamed = lookup(people, sales.withColumnRenamed("k", "who"), "k", "who", ["sale"])
    assert renamed.columns == ["k", "name", "v", "sale"] and renamed.count() == 5


def test_cross_join(people, sales):
    pairs = cross_join(people.select("name"), sales.select("sale"))
    assert pairs.count() == 16
    keyed = cross_join(
        people.withColumnRenamed("k", "p"), sales.select(F.col("k").alias("s"), "sale"), "p = s AND sale > 100"
    )
    assert keyed.count() == 1
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_union(people):
    three = [people, people, people.limit(0)]
    assert union_tables(three, "union_all").count() == 8
    assert union_tables(three).count() == 4
    wide = union_tables([people, people.drop("v")], "union_all", by_name=True)
    assert wide.filter("v IS NULL").count() == 4
    with pytest.raises(ValueError):
        union_tables([people])
    with pytest.raises(ValueError):
        union_tables(three, "minus")


def test_adaptive_execution_splits_hot_inner_joins(spark):
    """The inner join relies on it, so it must apply to the plan we build."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        facts = spark.range(0, 60_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
        )
        names = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("name"))
        joined = join_tables(facts, names, ["k"])
        assert len(joined.collect()) == 60_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
