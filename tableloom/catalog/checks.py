"""Queries over round trips, recorded runs, file dialects and error bounds."""

from pyspark.sql import functions as F

from ..functions.storage import new_folder
from ..operators import quality as q
from ..operators.aggregates import distinct_counts, statistics
from ..operators.joins import lookup
from ..operators.sorting import head, sort_rows
from ..operators.windows import window_functions
from ..plans import graph as g
from ..plans.provenance import consolidate, read_provenance
from ..plans.runs import check_against_spec, run_steps, steps_from_spec
from ..sources import writers as w
from ..sources.readers import Workspace, read_csv_as_text, read_table
from .registry import query, table

# --- step lists that are written, read back and run again ---------------------------

_SPEC = [
    {
        "inputs": ["orders"],
        "operator": "window_functions",
        "parameters": {
            "partition_columns": ["o_custkey"],
            "order_columns": [("o_orderdate", "desc"), "o_orderkey"],
            "window_functions": {"place": "row_number", "earlier": ("lead", "o_orderkey", 2)},
        },
        "output": "placed",
    },
    {
        "inputs": ["placed"],
        "operator": "rolling_aggregation",
        "parameters": {
            "partition_columns": ["o_custkey"],
            "order_column": ("place", "desc"),
            "window_size": 2,
            "agg_column": "o_orderkey",
            "agg_function": "max",
        },
    },
]
_SPEC_SQL = """
    SELECT o_orderkey, place, earlier,
           max(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY place DESC
                                 ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS rolling_max_2
    FROM (SELECT o_orderkey, o_custkey, row_number() OVER win::INTEGER AS place,
                 lead(o_orderkey, 2) OVER win AS earlier
          FROM orders WINDOW win AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey))"""


def _orders(spark, sf_dir):
    workspace = Workspace(spark)
    workspace.load("orders", f"{sf_dir}/orders.parquet", "parquet")
    return workspace


@query("spec_rerun", _SPEC_SQL)
def spec_rerun(spark, sf_dir):
    first = run_steps(_orders(spark, sf_dir), _SPEC, measure=True)
    path = new_folder(spark, "spec")
    w.export_spec(spark, first.steps(), {"orders": {"path": f"{sf_dir}/orders.parquet"}}, path)
    spec = read_table(spark, path, "json")
    again = run_steps(_orders(spark, sf_dir), steps_from_spec(spec), measure=True)
    if not check_against_spec(again, spec).isEmpty():
        raise RuntimeError("the run differs from its specification")
    return again.result.select("o_orderkey", "place", "earlier", "rolling_max_2")


@query(
    "run_log_edges",
    """SELECT * FROM (VALUES
        ('orders', 'transform_1', 'consumes'), ('transform_1', 'placed', 'produces'),
        ('orders', 'placed', 'dependency'), ('placed', 'transform_2', 'consumes'),
        ('transform_2', 'placed_rolling_aggregation_2', 'produces'),
        ('placed', 'placed_rolling_aggregation_2', 'dependency')) AS t(src, dst, edge_type),
       (SELECT count(*) AS source_rows FROM orders)""",
)
def run_log_edges(spark, sf_dir):
    """The graph of what a run logged, exported and read back."""
    workspace = _orders(spark, sf_dir)
    run = run_steps(workspace, _SPEC)
    folder = new_folder(spark, "run-log")
    output = run.records[-1][4]
    workspace.save(output, f"{folder}/result")
    workspace.log.export(spark, f"{folder}/log")
    logged = read_provenance(spark, [f"{folder}/log"])
    edges = g.build_edges(logged)

    def short(end):
        return F.regexp_replace(end, f"^transform_{workspace.log.run_id}_", "transform_").alias(end)

    rows = spark.read.parquet(f"{folder}/result").agg(F.count(F.lit(1)).alias("source_rows"))
    return edges.select(short("src"), short("dst"), "edge_type").join(F.broadcast(rows))


@query(
    "run_log_records",
    """SELECT 'orders' AS name, 'source' AS node_type, NULL::BIGINT AS input_rows, NULL::BIGINT AS output_rows
       UNION ALL SELECT 'orders_of_' || lower(o_orderstatus), 'sink',
              (SELECT count(*) FROM orders), count(*) FROM orders GROUP BY o_orderstatus""",
)
def run_log_records(spark, sf_dir):
    """Source, sinks and what every step recorded, of a run that splits a table by its values."""
    workspace = _orders(spark, sf_dir)
    values = [r[0] for r in table(spark, sf_dir, "orders").select("o_orderstatus").distinct().collect()]
    steps = [
        {
            "inputs": ["orders"],
            "operator": "filter",
            "parameters": {"condition": f"o_orderstatus = '{v}'"},
            "output": f"orders_of_{v.lower()}",
        }
        for v in values
    ]
    run_steps(workspace, steps, measure=True)
    folder = new_folder(spark, "run-log")
    for step in steps:
        workspace.save(step["output"], f"{folder}/{step['output']}")
    workspace.log.export(spark, f"{folder}/log")
    logged = read_provenance(spark, [f"{folder}/log"])
    recorded = logged["transformations"].select(
        F.col("output_table").alias("name"),
        *[F.col("metadata")[n].cast("bigint").alias(n) for n in ("input_rows", "output_rows")],
    )
    nodes = g.typed_names(logged).filter("node_type != 'transformation'")
    return nodes.join(recorded, "name", "left").select("name", "node_type", "input_rows", "output_rows")


@query(
    "load_records",
    """SELECT 'part' AS name, 'csv' AS type, true AS degraded, count(*) AS "rows",
              (SELECT count(*) FROM information_schema.columns WHERE table_name = 'part') AS columns FROM part
       UNION ALL SELECT 'customer', 'json', false, count(*),
              (SELECT count(*) FROM information_schema.columns WHERE table_name = 'customer') FROM customer
       UNION ALL SELECT 'orders', 'parquet', false, count(*),
              (SELECT count(*) FROM information_schema.columns WHERE table_name = 'orders') FROM orders""",
)
def load_records(spark, sf_dir):
    """What a load records of its sources: kind, schema, rows, and which were read as text.

    The CSV files are read with a setting for typed columns that Spark refuses.
    """
    folder = new_folder(spark, "catalogue")
    kinds = {"part": "csv", "customer": "json", "orders": "parquet"}
    for name, kind in kinds.items():
        w.write_table(table(spark, sf_dir, name), f"{folder}/{name}", kind)
    workspace = Workspace(spark)
    catalogue = {n: {"path": f"/{n}", "format": k} for n, k in kinds.items()}
    catalogue["part"]["schema"] = "not a schema ("
    workspace.load_all(catalogue, folder)
    rows = [(n, n in workspace.degraded, workspace.rows(n)) for n in kinds]
    found = spark.createDataFrame(rows, "name string, degraded boolean, rows bigint")
    return workspace.log.tables(spark)["data_sources"].select(
        "name", "type", F.size("schema").cast("bigint").alias("columns")
    ).join(found, "name")


@query(
    "dataset_information",
    """SELECT 'shape' AS part, 'total_rows' AS name, count(*)::VARCHAR AS value FROM orders
       UNION ALL SELECT 'shape', 'total_columns', '3'
       UNION ALL SELECT 'schema', column_name, CASE data_type WHEN 'VARCHAR' THEN 'string' ELSE lower(data_type) END
       FROM information_schema.columns
       WHERE table_name = 'orders' AND column_name IN ('o_orderkey', 'o_custkey', 'o_orderstatus')
       UNION ALL (SELECT 'preview', o_orderkey::VARCHAR, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5)""",
)
def dataset_information(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    info = q.dataset_info(sort_rows(orders, ["o_orderkey"]))
    shape = info["shape"].select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in info["shape"].columns]
            )
        )
    )
    parts = {
        "shape": shape,
        "schema": info["schema"].select(F.col("column").alias("name"), F.col("data_type").alias("value")),
        "preview": info["preview"].select(F.col("o_orderkey").cast("string"), "o_orderstatus"),
    }
    named = [df.toDF("name", "value").select(F.lit(p).alias("part"), "name", "value") for p, df in parts.items()]
    return named[0].union(named[1]).union(named[2])


# --- files in other dialects --------------------------------------------------------

_CUSTOMERS_SQL = """
    SELECT c_custkey, c_name || chr(10) || 'é; "' || c_mktsegment || '"' AS note FROM customer"""


def _written_dialect(spark, sf_dir):
    folder = new_folder(spark, "dialect")
    note = F.concat("c_name", F.lit('\né; "'), "c_mktsegment", F.lit('"'))
    table(spark, sf_dir, "customer").select("c_custkey", note.alias("note")).write.options(
        sep=";", encoding="ISO-8859-1", header=True, escape='"'
    ).csv(f"{folder}/notes")
    return folder


_DIALECT = {"sep": ";", "encoding": "ISO-8859-1", "header": "true", "multiLine": "true"}


@query("load_dialect", _CUSTOMERS_SQL)
def load_dialect(spark, sf_dir):
    folder = _written_dialect(spark, sf_dir)
    catalogue = {
        "notes": {"path": "/notes", "options": _DIALECT, "schema": "c_custkey long, note string"}
    }
    return Workspace(spark).load_all(catalogue, folder)["notes"]


@query("load_dialect_as_text", f"SELECT c_custkey::VARCHAR AS c_custkey, note FROM ({_CUSTOMERS_SQL})")
def load_dialect_as_text(spark, sf_dir):
    folder = _written_dialect(spark, sf_dir)
    return read_csv_as_text(spark, f"{folder}/notes", options=_DIALECT)


# --- lookups, consolidation, exports ------------------------------------------------


@query(
    "lookup_all_columns",
    """SELECT o_orderkey, c_name, c_nationkey, c_mktsegment, round(c_acctbal, 2) AS c_acctbal
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def lookup_all_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    found = lookup(orders, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey", [])
    return found.select(
        "o_orderkey", "c_name", "c_nationkey", "c_mktsegment", F.round("c_acctbal", 2).alias("c_acctbal")
    )


def _runs(spark, sf_dir):
    """Three runs about the same customers; later ones know more columns."""
    customer = table(spark, sf_dir, "customer")
    for number in (2, 3, 1):
        run = F.lit(f"r{number}")
        name = F.concat(F.lit("t"), F.col("c_custkey"))
        at = F.lit(f"2024-01-0{number} 00:00:00").cast("timestamp")
        facts = [run.alias("run_id"), name.alias("name"), F.lit("csv").alias("type")]
        place = F.concat(F.lit("in/"), name).alias("location")
        columns = F.map_from_arrays(
            F.array(*[F.lit(f"c{i}") for i in range(number)]), F.array(*[F.lit("int")] * number)
        )
        yield {
            "data_sources": customer.select(*facts, place, columns.alias("schema"), at.alias("ts")),
            "data_sinks": customer.select(*facts, place, at.alias("ts")),
            "transformations": customer.select(
                F.lit("r1").alias("run_id"), F.concat(F.lit("r1_"), "c_custkey").alias("id"),
                F.lit(number).alias("seq"), F.col("c_mktsegment").alias("name"),
                F.array(name).alias("input_tables"), name.alias("output_table"),
                F.lit("x" * 150).alias("transformation_logic"),
                F.create_map(F.lit("input_rows"), F.lit(str(number))).alias("metadata"), at.alias("ts"),
            ),
            "dependencies": customer.select(
                F.lit("r1").alias("run_id"), name.alias("source"), name.alias("target"),
                F.concat(F.lit("r1_"), "c_custkey").alias("transformation_id"),
            ),
        }


@query(
    "provenance_consolidated_lists",
    """SELECT 'data_sources' AS list, 't' || c_custkey AS name, 'r3' AS run_id, 3 AS detail FROM customer
       UNION ALL SELECT 'data_sinks', 't' || c_custkey, 'r3', 0 FROM customer
       UNION ALL SELECT 'transformations', 'r1_' || c_custkey, 'r1', 3 FROM customer
       UNION ALL SELECT 'dependencies', 'r1_' || c_custkey, 'r1', 0 FROM customer""",
)
def provenance_consolidated_lists(spark, sf_dir):
    lists = consolidate(list(_runs(spark, sf_dir)))
    shown = {
        "data_sources": ("name", F.size("schema")),
        "data_sinks": ("name", F.lit(0)),
        "transformations": ("id", F.col("seq")),
        "dependencies": ("transformation_id", F.lit(0)),
    }
    parts = [
        lists[k].select(F.lit(k).alias("list"), F.col(name).alias("name"), "run_id", detail.alias("detail"))
        for k, (name, detail) in shown.items()
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query(
    "export_with_broken_table",
    """SELECT 'dataset' AS kind, 'part' AS name, count(*) AS "rows", false AS failed FROM part
       UNION ALL SELECT 'sample', 'part', least(count(*), 100), false FROM part
       UNION ALL SELECT 'dataset', 'broken', NULL, true
       UNION ALL SELECT 'quality', 'broken', NULL, true
       UNION ALL SELECT 'quality', 'part', 1, false""",
)
def export_with_broken_table(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    broken = part.select(F.when(F.col("p_partkey") >= 0, F.raise_error(F.lit("bad"))).alias("x"))
    tables = {"broken": broken, "part": part}
    folder = new_folder(spark, "export")
    written = w.export_tables(tables, folder) + w.export_quality(tables, folder)
    return w.export_manifest(spark, written, folder).select(
        "kind", "name", "rows", F.col("error").isNotNull().alias("failed")
    )


# --- order, samples and error bounds ------------------------------------------------


@query(
    "sort_rows_places",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_totalprice DESC, o_orderkey)::BIGINT AS place
       FROM orders""",
)
def sort_rows_places(spark, sf_dir):
    """The order itself: places taken from the sorted rows' partitions."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    ordered = sort_rows(orders, ["o_custkey", ("o_totalprice", "desc"), "o_orderkey"])
    placed = ordered.select("o_orderkey", F.monotonically_increasing_id().alias("at"))
    return window_functions(placed, [], ["at"], {"place": "row_number"}).select(
        "o_orderkey", F.col("place").cast("long").alias("place")
    )


@query("preview_rows", "SELECT 10::BIGINT AS shown, 10::BIGINT AS known")
def preview_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    shown = head(orders, 10)
    known = shown.join(orders.select("o_orderkey").distinct(), "o_orderkey", "left_semi")
    return shown.agg(F.count(F.lit(1)).alias("shown")).crossJoin(
        known.agg(F.count(F.lit(1)).alias("known"))
    )


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "statistics_approximate_bounds",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", true AS within, count({c}) AS "count" FROM lineitem""" for c in _NUMBERS
    ),
)
def statistics_approximate_bounds(spark, sf_dir):
    """Whether every approximate quartile's true rank is within 0.001 of the one asked for."""
    lines = table(spark, sf_dir, "lineitem")
    found = {r["column"]: r for r in statistics(lines, _NUMBERS).collect()}  # a row per column
    rows = []
    for c in _NUMBERS:
        within = F.lit(True)
        for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            value = F.lit(found[c][name])
            below = F.count_if(F.col(c) < value) / F.count(c)
            reached = F.count_if(F.col(c) <= value) / F.count(c)
            within = within & (below <= share + 0.001) & (reached >= share - 0.001)
        rows.append(F.struct(F.lit(c).alias("column"), within.alias("within"), F.count(c).alias("count")))
    return lines.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


@query(
    "count_distinct_approximate_bounds",
    """SELECT true AS l_partkey, true AS l_suppkey, true AS l_returnflag""",
)
def count_distinct_approximate_bounds(spark, sf_dir):
    """Whether each estimate is within 10 % (two standard errors) of the count."""
    columns = ["l_partkey", "l_suppkey", "l_returnflag"]
    lines = table(spark, sf_dir, "lineitem")
    about = distinct_counts(lines, columns, approximate=True)
    exact = distinct_counts(lines, columns).withColumnsRenamed(
        {f"{c}_distinct": f"{c}_exact" for c in columns}
    )
    return about.crossJoin(exact).select(
        *[
            (F.abs(F.col(f"{c}_distinct") - F.col(f"{c}_exact")) <= 0.1 * F.col(f"{c}_exact")).alias(c)
            for c in columns
        ]
    )


@query(
    "profile_dates",
    """SELECT 'o_orderdate' AS "column", count_if(d IS NULL) AS null_count,
              count(DISTINCT d) + max((d IS NULL)::INTEGER) AS distinct_count,
              round(count(d) * 100.0 / count(*), 6) AS completeness
       FROM (SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS d FROM orders)""",
)
def profile_dates(spark, sf_dir):
    dates = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")).alias("o_orderdate")
    )
    return q.column_profile(dates).select(
        "column", "null_count", "distinct_count", F.round("completeness", 6).alias("completeness")
    )


@query(
    "duplicate_orders_with_dates",
    """SELECT 2 * count(*) AS total_rows, count(*) AS duplicate_count, 50.0::DOUBLE AS duplicate_percentage
       FROM orders""",
)
def duplicate_orders_with_dates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return q.duplicate_rows(orders.union(orders))
