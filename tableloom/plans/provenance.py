"""Provenance records and their tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "data_sources": (
        "run_id string, name string, type string, location string, "
        "schema map<string,string>, ts timestamp"
    ),
    "data_sinks": (
        "run_id string, name string, type string, location string, ts timestamp"
    ),
    "transformations": (
        "run_id string, id string, seq int, name string, input_tables array<string>, "
        "output_table string, transformation_logic string, "
        "metadata map<string,string>, ts timestamp"
    ),
    "dependencies": "run_id string, source string, target string, transformation_id string",
}

NATURAL_KEYS = {
    "data_sources": ["name", "type", "location"],
    "data_sinks": ["name", "type", "location"],
    "transformations": ["run_id", "id"],
    "dependencies": ["run_id", "source", "target", "transformation_id"],
}


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class ProvenanceLog:
    """What one run read, computed and wrote; a few records per step."""

    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    records: dict[str, list[tuple]] = field(
        default_factory=lambda: {name: [] for name in SCHEMAS}
    )

    def add_source(
        self, name: str, kind: str, location: str, df: DataFrame | None = None
    ) -> None:
        schema = {} if df is None else dict(df.dtypes)
        self.records["data_sources"].append(
            (self.run_id, name, kind, location, schema, _now())
        )

    def add_sink(self, name: str, kind: str, location: str) -> None:
        self.records["data_sinks"].append((self.run_id, name, kind, location, _now()))

    def add_transformation(
        self,
        name: str,
        inputs: Sequence[str],
        output: str,
        logic: str = "",
        metadata: Mapping | None = None,
    ) -> str:
        """Record a transformation and one dependency per input; returns its id."""
        seq = len(self.records["transformations"]) + 1
        identity = f"{self.run_id}_{seq}"
        described = {
            k: v if isinstance(v, str) else json.dumps(v, default=str)
            for k, v in (metadata or {}).items()
        }
        self.records["transformations"].append(
            (self.run_id, identity, seq, name, list(inputs), output, logic, described, _now())
        )
        self.records["dependencies"].extend(
            (self.run_id, source, output, identity) for source in inputs
        )
        return identity

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {
            name: spark.createDataFrame(self.records[name], schema)
            for name, schema in SCHEMAS.items()
        }

    def export(self, spark: SparkSession, folder: str) -> None:
        """Write the four lists below ``folder`` as JSON lines."""
        for name, table in self.tables(spark).items():
            table.write.mode("overwrite").json(f"{folder}/{name}")


def read_provenance(spark: SparkSession, folders: Sequence[str]) -> dict[str, DataFrame]:
    """The lists of all runs exported to ``folders``, missing ones skipped."""
    found = {name: [] for name in SCHEMAS}
    for folder in folders:
        for name, schema in SCHEMAS.items():
            try:
                table = spark.read.schema(schema).json(f"{folder}/{name}")
            except AnalysisException as error:
                if (error.getCondition() or "") != "PATH_NOT_FOUND":
                    raise
                continue
            found[name].append(table)
    return {
        name: reduce(DataFrame.unionByName, tables)
        if tables
        else spark.createDataFrame([], SCHEMAS[name])
        for name, tables in found.items()
    }


def consolidate(recorded: Sequence[Mapping[str, DataFrame]]) -> dict[str, DataFrame]:
    """One set of lists from several runs, without repeated records.

    Of records with the same key the latest stays (the greatest run id among
    equals); the result does not depend on the order of the runs.
    """
    return {
        name: _latest(reduce(DataFrame.unionByName, [lists[name] for lists in recorded]), keys)
        for name, keys in NATURAL_KEYS.items()
    }


def _latest(records: DataFrame, keys: list[str]) -> DataFrame:
    # Maps have no order; their text has one, which settles what is left.
    maps = [f.name for f in records.schema.fields if f.dataType.typeName() == "map"]
    newest = [F.col(c) for c in ("ts", "run_id") if c in records.columns]
    rest = [F.to_json(c) if c in maps else F.col(c) for c in records.columns]
    whole = F.struct(*records.columns)
    return (
        records.groupBy(*keys)
        .agg(F.max_by(whole, F.struct(*newest, *rest)).alias("record"))
        .select("record.*")
    )


def overview(provenance: Mapping[str, DataFrame]) -> DataFrame:
    """Number of records per list."""
    return reduce(
        DataFrame.unionByName,
        [
            table.agg(F.count(F.lit(1)).alias("records")).select(
                F.lit(name).alias("list"), "records"
            )
            for name, table in provenance.items()
        ],
    )


def transformation_listing(provenance: Mapping[str, DataFrame]) -> DataFrame:
    """Transformations with their inputs, logic and rows in and out."""
    return provenance["transformations"].select(
        "id",
        "name",
        F.concat_ws(", ", "input_tables").alias("inputs"),
        F.col("output_table").alias("output"),
        F.col("transformation_logic").alias("logic"),
        F.col("metadata")["input_rows"].cast("bigint").alias("input_rows"),
        F.col("metadata")["output_rows"].cast("bigint").alias("output_rows"),
    )
