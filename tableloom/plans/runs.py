"""Running a list of steps over named tables."""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ..functions.storage import store
from ..sources.readers import Workspace
from .registry import OPERATORS, find

STEP_SCHEMA = (
    "run_id string, step int, transformation string, inputs array<string>, "
    "output_name string, input_rows bigint, output_rows bigint, output_cols int, "
    "parameters string, ts timestamp, success boolean, error string, elapsed_ms bigint"
)
CHANGE_SCHEMA = (
    "step int, transformation string, column string, change string, "
    "type_before string, type_after string"
)


@dataclass
class Run:
    """The outcome of a step list: its records and the schema of each table."""

    workspace: Workspace
    records: list[tuple] = field(default_factory=list)

    @property
    def spark(self) -> SparkSession:
        return self.workspace.spark

    @property
    def result(self) -> DataFrame:
        """The table of the last step; a failed run has none."""
        if not self.records:
            raise ValueError("no step was run")
        last = self.records[-1]
        if last[10] is False:
            raise RuntimeError(f"step {last[1]} ({last[2]}) failed: {last[11]}")
        return self.workspace.tables[last[4]]

    def steps(self) -> DataFrame:
        return self.spark.createDataFrame(self.records, STEP_SCHEMA)

    def schema_evolution(self) -> DataFrame:
        """Added, removed, retyped and preserved columns of every step.

        A step is compared with its first input. Only schemas are looked at.
        """
        changes = []
        for record in self.records:
            if record[10] is False:
                continue
            before = dict(self.workspace.tables[record[3][0]].dtypes)
            after = dict(self.workspace.tables[record[4]].dtypes)
            for column in [*before, *(c for c in after if c not in before)]:
                old, new = before.get(column), after.get(column)
                change = (
                    "added" if old is None
                    else "removed" if new is None
                    else "preserved" if old == new
                    else "retyped"
                )
                changes.append((record[1], record[2], column, change, old, new))
        return self.spark.createDataFrame(changes, CHANGE_SCHEMA)


def run_steps(
    workspace: Workspace, steps: Sequence[Mapping], measure: bool = False
) -> Run:
    """Run steps in order; outputs are inputs of later steps; stop at a failure.

    A step is ``{"inputs": [names], "operator": key, "parameters": {...}}`` with
    an optional ``output`` name; ``dataset`` and ``transform_key`` are accepted
    too. Plans stay lazy unless ``measure`` is set: then each output is written
    to the shared folder, timed, counted from its files and read back by the
    following steps, so no step computes an earlier one again and the counts
    hold even if a task ran twice. A lazy step is only planned: its ``success``
    is NULL, since its rows may still fail.
    """
    run = Run(workspace)
    counts: dict[str, int] = {}

    def rows(name: str) -> int | None:
        if not measure:
            return None
        if name not in counts:
            counts[name] = workspace.tables[name].count()
        return counts[name]

    for number, step in enumerate(steps, 1):
        inputs = list(step.get("inputs") or [step["dataset"]])
        key = step.get("operator") or step["transform_key"]
        parameters = dict(step.get("parameters") or {})
        output = step.get("output") or f"{inputs[0]}_{key}_{number}"
        name = step.get("transform_name") or key
        started, at = time.monotonic(), datetime.now(timezone.utc)
        try:
            operator = find(key, step.get("category"))
            name = step.get("transform_name") or operator.name
            _check_inputs(workspace, operator.inputs, inputs)
            df = operator.function(
                *[workspace.tables[i] for i in inputs], **parameters
            )
            if measure:
                df = store(df, "step")
            workspace.add(output, df)
            elapsed = int((time.monotonic() - started) * 1000) if measure else None
            before, after = rows(inputs[0]), rows(output)
        except Exception as error:  # any operator failure ends the run
            run.records.append(
                (
                    workspace.log.run_id, number, name, inputs, output, None, None, None,
                    json.dumps(parameters, default=str), at, False, str(error), None,
                )
            )
            break
        run.records.append(
            (
                workspace.log.run_id, number, name, inputs, output, before, after,
                len(df.columns), json.dumps(parameters, default=str), at,
                True if measure else None, None, elapsed,
            )
        )
        metadata = dict(parameters)
        if measure:
            metadata |= {"input_rows": before, "output_rows": after}
        workspace.log.add_transformation(
            name, inputs, output, f"{key} {json.dumps(parameters, default=str)}", metadata
        )
    return run


def _check_inputs(workspace: Workspace, wanted: int | str, inputs: list[str]) -> None:
    if wanted == "many" and len(inputs) < 2 or isinstance(wanted, int) and len(inputs) != wanted:
        raise ValueError(f"operator takes {wanted} inputs, got {len(inputs)}")
    for name in inputs:
        if name not in workspace.tables:
            raise ValueError(f"unknown dataset: {name}")


def steps_from_spec(spec: DataFrame) -> list[dict]:
    """The step list of an exported specification (one small row per step)."""
    return [
        {
            "inputs": list(row["inputs"]),
            "transform_name": row["transformation"],
            "operator": _key_of(row["transformation"]),
            "parameters": json.loads(row["parameters"]),
            "output": row["output_name"],
        }
        for row in spec.orderBy("step").collect()
    ]


def _key_of(name: str) -> str:
    for operators in OPERATORS.values():
        for key, operator in operators.items():
            if name in (operator.name, key):
                return key
    raise ValueError(f"no operator named {name}")


def check_against_spec(run: Run, spec: DataFrame) -> DataFrame:
    """Steps whose rows or columns differ from the expected ones."""
    actual = run.steps().select("step", "output_rows", "output_cols")
    return (
        spec.select("step", "output_name", "expected_rows", "expected_columns")
        .join(actual, "step", "left")
        .filter(
            "NOT (expected_rows <=> output_rows AND expected_columns <=> output_cols)"
        )
    )
