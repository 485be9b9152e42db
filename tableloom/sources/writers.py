"""Writing tables and exports."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import assess

MODES = ("overwrite", "append", "ignore", "error", "errorifexists")
SAMPLE_ROWS = 100

MANIFEST = "path string, kind string, name string, rows bigint, error string"


def write_table(
    df: DataFrame, path: str, format_type: str = "parquet", mode: str = "overwrite"
) -> None:
    """Write Parquet, CSV (with a header) or JSON lines."""
    kind = format_type.lower()
    if kind not in ("parquet", "csv", "json"):
        raise ValueError(f"unsupported format: {format_type}")
    if mode not in MODES:
        raise ValueError(f"unsupported write mode: {mode}")
    writer = df.write.mode(mode)
    if kind == "csv":
        # Values come back as they were: quotes doubled, outer blanks kept.
        writer = writer.options(
            header=True,
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
    writer.format(kind).save(path)


def export_tables(
    tables: Mapping[str, DataFrame], folder: str
) -> list[tuple[str, str, str, int, str | None]]:
    """Every table as Parquet plus a CSV sample of 100 rows; returns manifest rows.

    The sample and the row count come from the written files, not from a second
    run of the plan. A table that cannot be computed or written does not stop
    the rest: its manifest row has no count but says why.
    """
    written = []
    for name, df in tables.items():
        path = f"{folder}/datasets/{name}"
        try:
            df.write.mode("overwrite").parquet(path)
            stored = df.sparkSession.read.schema(df.schema).parquet(path)
            sample = f"{folder}/datasets/{name}_sample"
            write_table(_flat(stored.limit(SAMPLE_ROWS)).coalesce(1), sample, "csv")
            rows = stored.count()
        except Exception as error:  # whatever a table's plan raises
            written.append((path, "dataset", name, None, _reason(error)))
            continue
        written.append((path, "dataset", name, rows, None))
        written.append((sample, "sample", name, min(rows, SAMPLE_ROWS), None))
    return written


def _reason(error: Exception) -> str:
    return str(error).strip().split("\n")[0]


def export_provenance(
    lists: Mapping[str, DataFrame], folder: str
) -> list[tuple[str, str, str, int, str | None]]:
    """The provenance lists as JSON lines below ``folder``."""
    written = []
    for name, df in lists.items():
        path = f"{folder}/provenance/{name}"
        write_table(df, path, "json")
        written.append((path, "provenance", name, df.count(), None))
    return written


def _flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, which CSV can hold."""
    nested = [
        f.name
        for f in df.schema.fields
        if f.dataType.typeName() in ("array", "map", "struct")
    ]
    return df.withColumns({c: F.to_json(c) for c in nested})


def export_steps(steps: DataFrame, folder: str) -> list[tuple[str, str, str, int, str | None]]:
    """The step records as JSON and their summary as CSV."""
    write_table(steps, f"{folder}/execution_results", "json")
    write_table(_flat(steps), f"{folder}/execution_summary", "csv")
    rows = steps.count()
    return [
        (f"{folder}/execution_results", "steps", "execution_results", rows, None),
        (f"{folder}/execution_summary", "steps", "execution_summary", rows, None),
    ]


def export_quality(
    tables: Mapping[str, DataFrame], folder: str
) -> list[tuple[str, str, str, int, str | None]]:
    """The quality assessment of every table as JSON."""
    written = []
    for name, df in tables.items():
        path = f"{folder}/quality_reports/{name}"
        try:
            write_table(assess(df).select(F.lit(name).alias("dataset"), "*"), path, "json")
        except Exception as error:  # whatever a table's plan raises
            written.append((path, "quality", name, None, _reason(error)))
            continue
        written.append((path, "quality", name, 1, None))
    return written


def export_graph(
    nodes: DataFrame, edges: DataFrame, folder: str
) -> list[tuple[str, str, str, int, str | None]]:
    """Provenance nodes and edges as JSON lines."""
    written = []
    for name, df in (("nodes", nodes), ("links", edges)):
        path = f"{folder}/graph/{name}"
        write_table(df, path, "json")
        rows = df.sparkSession.read.schema(df.schema).json(path).count()
        written.append((path, "graph", name, rows, None))
    return written


def export_manifest(
    spark: SparkSession, written: list[tuple[str, str, str, int, str | None]], folder: str
) -> DataFrame:
    """The list of exported files, written as JSON and returned."""
    manifest = spark.createDataFrame(written, MANIFEST)
    write_table(manifest.coalesce(1), f"{folder}/manifest", "json")
    return manifest


def export_spec(
    spark: SparkSession,
    steps: DataFrame,
    sources: Mapping[str, Mapping],
    path: str,
) -> DataFrame:
    """A runnable description: per step its parameters and the expected shape."""
    spec = steps.filter("coalesce(success, true)").select(
        "step",
        "transformation",
        "inputs",
        "output_name",
        "parameters",
        F.col("output_rows").alias("expected_rows"),
        F.col("output_cols").alias("expected_columns"),
        F.lit(json.dumps(sources, sort_keys=True)).alias("sources"),
    )
    write_table(spec, path, "json")
    return spec
