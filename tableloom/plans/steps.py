"""Questions about the records of executed steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windows import window_functions


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part * 100.0 / whole, 1))


def results_summary(steps: DataFrame) -> DataFrame:
    return steps.filter("coalesce(success, true)").select(
        "step",
        "transformation",
        F.concat_ws(", ", "inputs").alias("input"),
        F.col("output_name").alias("output"),
        F.col("output_rows").alias("rows"),
        F.col("output_cols").alias("columns"),
    )


def record_impact(steps: DataFrame) -> DataFrame:
    """Change in the number of rows by each step, in percent of its input."""
    change = F.col("output_rows") - F.col("input_rows")
    return steps.filter("coalesce(success, true)").select(
        "step",
        "transformation",
        "input_rows",
        "output_rows",
        _percent(change, F.col("input_rows")).alias("change_percentage"),
    )


def throughput(steps: DataFrame) -> DataFrame:
    """One row: steps, rows in, rows out, and out / in in percent."""
    totals = steps.filter("coalesce(success, true)").agg(
        F.count(F.lit(1)).alias("transformations"),
        F.sum("input_rows").alias("total_input_rows"),
        F.sum("output_rows").alias("total_output_rows"),
    )
    return totals.withColumn(
        "efficiency", _percent(F.col("total_output_rows"), F.col("total_input_rows"))
    )


def step_change(steps: DataFrame) -> DataFrame:
    """Rows of each step against the step before it in the list."""
    listed = window_functions(
        steps.filter("coalesce(success, true)").select(
            "run_id", "step", "transformation", "inputs", "output_name",
            "input_rows", "output_rows",
        ),
        ["run_id"],
        ["step"],
        {"previous_rows": "lag(output_rows)"},
    )
    change = F.col("output_rows") - F.col("previous_rows")
    percent = _percent(change, F.col("previous_rows"))
    return listed.select(
        "step",
        "transformation",
        F.element_at("inputs", 1).alias("input_dataset"),
        F.col("output_name").alias("output_dataset"),
        "previous_rows",
        "output_rows",
        change.alias("change"),
        percent.alias("change_percentage"),
        F.when(
            change.isNotNull(),
            F.format_string("%+d (%+.1f%%)", change, percent),
        ).alias("data_change"),
    )


def volume_series(steps: DataFrame) -> DataFrame:
    """(step, kind, rows): input and output rows along the run."""
    return steps.filter("coalesce(success, true)").select(
        "step",
        F.inline(
            F.array(
                F.struct(F.lit("input").alias("kind"), F.col("input_rows").alias("rows")),
                F.struct(F.lit("output").alias("kind"), F.col("output_rows").alias("rows")),
            )
        ),
    )


def run_statistics(steps: DataFrame) -> DataFrame:
    """Per run: number of steps, first input, last output, total time."""
    return (
        steps.filter("coalesce(success, true)")
        .groupBy("run_id")
        .agg(
            F.count(F.lit(1)).alias("steps"),
            F.min_by(F.element_at("inputs", 1), "step").alias("start_dataset"),
            F.max_by("output_name", "step").alias("final_dataset"),
            F.sum("elapsed_ms").alias("elapsed_ms"),
        )
    )


def step_timing(steps: DataFrame) -> DataFrame:
    """Time and rows per second of every measured step."""
    return steps.filter("success AND elapsed_ms IS NOT NULL").select(
        "step",
        "transformation",
        "elapsed_ms",
        F.when(
            F.col("elapsed_ms") > 0,
            F.round(F.col("input_rows") * 1000.0 / F.col("elapsed_ms"), 1),
        ).alias("rows_per_second"),
    )


def flow_links(steps: DataFrame) -> DataFrame:
    """Links dataset -> dataset, weighted by output rows."""
    return steps.filter("coalesce(success, true)").select(
        F.explode("inputs").alias("source"),
        F.col("output_name").alias("target"),
        F.col("output_rows").alias("value"),
        F.col("transformation").alias("label"),
    )


def flow_links_via_steps(steps: DataFrame) -> DataFrame:
    """Links input -> transformation -> output, weighted by output rows."""
    done = steps.filter("coalesce(success, true)")
    into = done.select(
        F.explode("inputs").alias("source"),
        F.col("transformation").alias("target"),
        F.col("output_rows").alias("value"),
    )
    out = done.select(
        F.col("transformation").alias("source"),
        F.col("output_name").alias("target"),
        F.col("output_rows").alias("value"),
    )
    return into.unionByName(out)


def step_graph(steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): datasets as nodes, transformations on the edges."""
    edges = flow_links(steps).select(
        F.col("source").alias("src"),
        F.col("target").alias("dst"),
        F.col("label").alias("transformation"),
    )
    made = edges.select(F.col("dst").alias("name"), F.lit("transformation").alias("node_type"))
    given = edges.select(F.col("src").alias("name"), F.lit("source").alias("node_type"))
    nodes = (
        made.unionByName(given)
        .groupBy("name")
        .agg(F.max("node_type").alias("node_type"))
    )
    return nodes, edges
