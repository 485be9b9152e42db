"""Queries over provenance graphs, executed steps and files."""

from pyspark.sql import functions as F

from ..functions.sizing import dealt_partitions_for
from ..functions.storage import new_folder
from ..operators.aggregates import row_count
from ..operators.joins import union_tables
from ..plans import graph as g
from ..plans import steps as st
from ..plans.provenance import consolidate, overview, transformation_listing
from ..plans.runs import run_steps
from ..sources import writers as w
from ..sources.readers import Workspace, read_stage, read_table
from ..sources.writers import write_table
from .planted import ORDERS_WITH_NULLS, orders_with_nulls
from .registry import query, table

# --- provenance graph ----------------------------------------------------------------
# Part p is the step that makes table t_k, k = p + 8, of t_(k div 2) and t_(k div 3).
# Tables nobody makes are the sources, tables nobody reads the sinks.

_FIRST = 8
_PROVENANCE = f"""
    WITH RECURSIVE step AS (
        SELECT p_partkey AS p, p_partkey + {_FIRST} AS k, p_type AS name FROM part),
    reads AS (SELECT DISTINCT p, k, 't_' || j AS input, 't_' || k AS output
              FROM (SELECT p, k, unnest([k // 2, k // 3]) AS j FROM step)),
    edge AS (
        SELECT input AS src, 'transform_p_' || p AS dst, 'consumes' AS edge_type,
               'p_' || p AS transformation_id FROM reads
        UNION ALL SELECT 'transform_p_' || p, 't_' || k, 'produces', 'p_' || p FROM step
        UNION ALL SELECT input, output, 'dependency', 'p_' || p FROM reads),
    source AS (SELECT DISTINCT input AS name FROM reads
               WHERE input NOT IN (SELECT output FROM reads)),
    sink AS (SELECT DISTINCT output AS name FROM reads
             WHERE output NOT IN (SELECT input FROM reads)),
    typed AS (
        SELECT name, 'source' AS node_type, name AS label FROM source
        UNION ALL SELECT name, 'sink', name FROM sink
        UNION ALL SELECT 'transform_p_' || p, 'transformation', name FROM step
        UNION ALL (SELECT DISTINCT output, 'intermediate', output FROM reads
                   WHERE output IN (SELECT input FROM reads))),
    node AS (
        SELECT name, node_type, label,
               (SELECT count(*) FROM edge WHERE dst = name) AS in_degree,
               (SELECT count(*) FROM edge WHERE src = name) AS out_degree
        FROM typed)
"""
# Every 16th step also reads a table of its own, so that the sources grow with the parts.
_SOURCE_EACH = 16
_WITH_SOURCES = _PROVENANCE.replace(
    "FROM (SELECT p, k, unnest([k // 2, k // 3]) AS j FROM step)),",
    f"""FROM (SELECT p, k, unnest([k // 2, k // 3]) AS j FROM step)
              UNION ALL SELECT p, k, 's_' || p, 't_' || k FROM step WHERE p % {_SOURCE_EACH} = 0),""",
)
# Shortest paths never pass through a step: its tables are linked directly.
_WALK = (
    _WITH_SOURCES
    + """,
    walk(root, node, path) AS (
        SELECT name, name, [name] FROM source
        UNION ALL
        SELECT root, output, list_append(path, output) FROM walk JOIN reads ON input = node),
    best AS (
        SELECT root AS source, node AS sink, path, len(path) - 1 AS length FROM (
            SELECT *, row_number() OVER (PARTITION BY root, node ORDER BY len(path), path) AS rn
            FROM walk WHERE node IN (SELECT name FROM sink))
        WHERE rn = 1)
"""
)
_START = "t_5"


def _near(name, forward):
    here, there = ("src", "dst") if forward else ("dst", "src")
    return f"""SELECT node, min(distance) AS distance FROM (
        WITH RECURSIVE near(node, distance) AS (
            SELECT '{name}', 0
            UNION SELECT {there}, distance + 1 FROM near JOIN edge ON {here} = node)
        SELECT * FROM near) WHERE node <> '{name}' GROUP BY node"""


def provenance_of_parts(
    spark, sf_dir, run="p", source="part", key="p_partkey", label="p_type", own_sources=False
):
    """A provenance set with one step per row of a given table."""
    k = F.col(key) + _FIRST

    def t(number):
        return F.concat(F.lit("t_"), number.cast("bigint"))

    steps = table(spark, sf_dir, source).select(
        F.lit(run).alias("run_id"),
        F.concat(F.lit(run + "_"), key).alias("id"),
        (F.col(key) + 1).cast("int").alias("seq"),
        F.col(label).alias("name"),
        F.concat(
            F.array_distinct(F.array(t(F.floor(k / 2)), t(F.floor(k / 3)))),
            F.when(
                F.lit(own_sources) & (F.col(key) % _SOURCE_EACH == 0),
                F.array(F.concat(F.lit("s_"), F.col(key).cast("bigint"))),
            ).otherwise(F.array().cast("array<string>")),
        ).alias("input_tables"),
        t(k).alias("output_table"),
        F.lit("halve and third").alias("transformation_logic"),
        F.create_map(F.lit("input_rows"), k.cast("string"), F.lit("output_rows"), F.col(key).cast("string")).alias("metadata"),
    )
    links = steps.select(
        "run_id",
        F.explode("input_tables").alias("source"),
        F.col("output_table").alias("target"),
        F.col("id").alias("transformation_id"),
    )
    # Counted, not joined: no side is sorted. A name that is null equals none. One file
    # may hold all parts, so the pairs go over many tasks before these collect names.
    dealt = links.select("source", "target").repartition(
        dealt_partitions_for(links, g.DEALT_BYTES), "source", "target"
    )
    ends = F.array(
        F.struct(F.col("source").alias("name"), F.lit(1).alias("read"), F.lit(0).alias("made")),
        F.struct(F.col("target").alias("name"), F.lit(0).alias("read"), F.lit(1).alias("made")),
    )
    used = dealt.select(F.inline(ends)).groupBy("name").agg(F.max("read").alias("read"), F.max("made").alias("made"))
    sources = used.filter("read = 1 AND (made = 0 OR name IS NULL)").select(F.col("name").alias("source"))
    sinks = used.filter("made = 1 AND (read = 0 OR name IS NULL)").select(F.col("name").alias("target"))

    def named(df, column):
        return df.select(
            F.lit(run).alias("run_id"),
            F.col(column).alias("name"),
            F.lit("parquet").alias("type"),
            F.concat(F.lit("tables/"), column).alias("location"),
        )

    return {
        "data_sources": named(sources, "source"),
        "data_sinks": named(sinks, "target"),
        "transformations": steps,
        "dependencies": links,
    }


def _graph(spark, sf_dir):
    return g.build_graph(provenance_of_parts(spark, sf_dir))


def _graph_with_sources(spark, sf_dir):
    return g.build_graph(provenance_of_parts(spark, sf_dir, own_sources=True))


@query("provenance_nodes", _PROVENANCE + "SELECT * FROM node")
def provenance_nodes(spark, sf_dir):
    return _graph(spark, sf_dir)[0]


@query("provenance_edges", _PROVENANCE + "SELECT * FROM edge")
def provenance_edges(spark, sf_dir):
    return _graph(spark, sf_dir)[1]


@query(
    "provenance_edges_through_steps",
    _PROVENANCE + "SELECT * FROM edge WHERE edge_type <> 'dependency'",
)
def provenance_edges_through_steps(spark, sf_dir):
    return g.build_edges(provenance_of_parts(spark, sf_dir), include_dependency_edges=False)


@query(
    "provenance_degrees",
    _PROVENANCE
    + """SELECT name, in_degree, out_degree,
                CASE WHEN in_degree = 0 THEN 'source' WHEN out_degree = 0 THEN 'final'
                     ELSE 'intermediate' END AS dataset_role
         FROM node""",
)
def provenance_degrees(spark, sf_dir):
    return g.degrees(g.build_edges(provenance_of_parts(spark, sf_dir)))


@query("provenance_downstream", _PROVENANCE + _near(_START, True))
def provenance_downstream(spark, sf_dir):
    return g.downstream(_graph(spark, sf_dir)[1], _START)


@query(
    "provenance_upstream",
    _PROVENANCE
    + _near("@", False).replace("'@'", "(SELECT 't_' || (max(k)) FROM step)"),
)
def provenance_upstream(spark, sf_dir):
    last = table(spark, sf_dir, "part").agg(F.max("p_partkey")).first()[0] + _FIRST
    return g.upstream(_graph(spark, sf_dir)[1], f"t_{last}")


_RELATED = f"""(SELECT node, min(role) AS role FROM (
        SELECT '{_START}' AS node, 'a' AS role
        UNION ALL SELECT node, 'b' FROM ({_near(_START, False)})
        UNION ALL SELECT node, 'c' FROM ({_near(_START, True)})) GROUP BY node)"""


@query(
    "provenance_impact",
    _PROVENANCE
    + f"""SELECT node, CASE role WHEN 'a' THEN 'selected' WHEN 'b' THEN 'upstream'
                            ELSE 'downstream' END AS role FROM {_RELATED}""",
)
def provenance_impact(spark, sf_dir):
    return g.impact(*_graph(spark, sf_dir), _START)[0]


@query(
    "provenance_impact_edges",
    _PROVENANCE
    + f""", related AS {_RELATED}
    SELECT * FROM edge WHERE src IN (SELECT node FROM related)
                         AND dst IN (SELECT node FROM related)""",
)
def provenance_impact_edges(spark, sf_dir):
    return g.impact(*_graph(spark, sf_dir), _START)[1]


@query("provenance_reachable", _WALK + "SELECT source, sink, length::INTEGER AS length FROM best")
def provenance_reachable(spark, sf_dir):
    return g.reachable_pairs(*_graph_with_sources(spark, sf_dir))


@query(
    "provenance_paths",
    _WALK
    + """SELECT source, sink, array_to_string(path, ' > ') AS path, length::INTEGER AS length
         FROM best""",
)
def provenance_paths(spark, sf_dir):
    paths = g.flow_paths(*_graph_with_sources(spark, sf_dir))
    return paths.withColumn("path", F.array_join("path", " > "))


@query(
    "provenance_path_positions",
    _WALK
    + """SELECT source, sink, position::INTEGER AS position, p.node, node_type
         FROM (SELECT source, sink, unnest(path) AS node,
                      generate_subscripts(path, 1) - 1 AS position FROM best) p
         JOIN node ON name = p.node""",
)
def provenance_path_positions(spark, sf_dir):
    nodes, edges = _graph_with_sources(spark, sf_dir)
    return g.path_positions(g.flow_paths(nodes, edges, with_types=True), nodes)


@query(
    "provenance_stats",
    _WALK
    + """SELECT (SELECT count(*) FROM node) AS total_nodes,
            (SELECT count(*) FROM source) AS data_sources,
            (SELECT count(*) FROM sink) AS data_sinks,
            (SELECT count(*) FROM node WHERE node_type = 'intermediate') AS intermediate_datasets,
            (SELECT count(*) FROM step) AS transformations,
            (SELECT count(*) FROM edge) AS total_edges,
            (SELECT count(*) FROM best) AS flow_paths,
            (SELECT max(length)::INTEGER FROM best) AS max_shortest_path,
            (SELECT name FROM node ORDER BY in_degree + out_degree DESC, name LIMIT 1)
                AS most_connected_node,
            (SELECT string_agg(name || ':' || uses, ', ' ORDER BY name) FROM (
                SELECT name, count(*) AS uses FROM step GROUP BY name)) AS transformation_types""",
)
def provenance_stats(spark, sf_dir):
    counted = F.transform("transformation_types", lambda t: F.concat_ws(":", t["name"], t["uses"].cast("string")))
    return g.graph_statistics(*_graph_with_sources(spark, sf_dir)).withColumn(
        "transformation_types", F.array_join(counted, ", ")
    )


@query(
    "provenance_node_types",
    _PROVENANCE + "SELECT node_type, count(*) AS nodes FROM node GROUP BY node_type",
)
def provenance_node_types(spark, sf_dir):
    return g.node_type_counts(_graph(spark, sf_dir)[0])


@query(
    "provenance_transformation_counts",
    "SELECT p_type AS name, count(*) AS uses FROM part GROUP BY p_type",
)
def provenance_transformation_counts(spark, sf_dir):
    return g.transformation_counts(provenance_of_parts(spark, sf_dir))


@query(
    "provenance_most_connected",
    _PROVENANCE
    + """SELECT name, in_degree + out_degree AS degree FROM node
         ORDER BY degree DESC, name LIMIT 1""",
)
def provenance_most_connected(spark, sf_dir):
    return g.most_connected(_graph(spark, sf_dir)[0])


@query(
    "provenance_matrix",
    _PROVENANCE + "SELECT src AS source, dst AS target, 1 AS connected FROM edge",
)
def provenance_matrix(spark, sf_dir):
    return g.dependency_matrix(_graph(spark, sf_dir)[1])


@query(
    "provenance_adjacency",
    _PROVENANCE + "SELECT DISTINCT input AS source, output AS target FROM reads",
)
def provenance_adjacency(spark, sf_dir):
    return g.adjacency(provenance_of_parts(spark, sf_dir)["dependencies"])


def _two_runs(spark, sf_dir):
    parts = provenance_of_parts(spark, sf_dir)
    customers = provenance_of_parts(
        spark, sf_dir, "c", "customer", "c_custkey", "c_mktsegment"
    )
    return consolidate([parts, customers, parts])


@query(
    "provenance_consolidated",
    f"""SELECT DISTINCT run_id, 't_' || j AS source, 't_' || k AS target,
               run_id || '_' || n AS transformation_id
        FROM (SELECT 'p' AS run_id, p_partkey AS n, p_partkey + {_FIRST} AS k,
                     unnest([k // 2, k // 3]) AS j FROM part
              UNION ALL SELECT 'c', c_custkey, c_custkey + {_FIRST} AS k,
                     unnest([k // 2, k // 3]) FROM customer)""",
)
def provenance_consolidated(spark, sf_dir):
    return _two_runs(spark, sf_dir)["dependencies"]


@query(
    "provenance_overview",
    f"""
    WITH run AS (
        SELECT 'p' AS run, p_partkey AS n, p_partkey + {_FIRST} AS k FROM part
        UNION ALL SELECT 'c', c_custkey, c_custkey + {_FIRST} FROM customer),
    reads AS (SELECT DISTINCT run, k, unnest([k // 2, k // 3]) AS j FROM run)
    SELECT 'transformations' AS list, count(*) AS records FROM run
    UNION ALL SELECT 'dependencies', count(*) FROM reads
    UNION ALL SELECT 'data_sources', count(DISTINCT j) FROM reads r
        WHERE NOT EXISTS (SELECT 1 FROM run WHERE run.run = r.run AND run.k = r.j)
    UNION ALL SELECT 'data_sinks', count(DISTINCT k) FROM run r
        WHERE NOT EXISTS (SELECT 1 FROM reads WHERE reads.run = r.run AND reads.j = r.k)
    """,
)
def provenance_overview(spark, sf_dir):
    return overview(_two_runs(spark, sf_dir))


@query(
    "provenance_listing",
    f"""SELECT 'p_' || p_partkey AS id, p_type AS name,
            CASE WHEN k // 2 = k // 3 THEN 't_' || k // 2
                 ELSE 't_' || k // 2 || ', t_' || k // 3 END AS inputs,
            't_' || k AS output, 'halve and third' AS logic, k AS input_rows,
            p_partkey AS output_rows
        FROM (SELECT p_partkey, p_type, p_partkey + {_FIRST} AS k FROM part)""",
)
def provenance_listing(spark, sf_dir):
    return transformation_listing(provenance_of_parts(spark, sf_dir))


# --- executed steps ---------------------------------------------------------------

_STEPS = [
    {
        "inputs": ["orders"],
        "operator": "remove_nulls",
        "parameters": {"columns": ["o_totalprice"]},
        "output": "priced",
    },
    {
        "inputs": ["priced", "customers"],
        "operator": "lookup",
        "parameters": {"main_key": "o_custkey", "lookup_key": "c_custkey"},
        "output": "named",
    },
    {
        "inputs": ["named"],
        "operator": "data_validation",
        "parameters": {"validation_rules": {"large": "o_totalprice > 100000"}},
        "output": "checked",
    },
    {
        "inputs": ["checked"],
        "operator": "group_by",
        "parameters": {
            "group_by_columns": ["c_mktsegment", "is_large"],
            "aggregations": {"o_totalprice": "sum"},
        },
        "output": "totals",
    },
]
_STEP_ROWS = f"""
    WITH orders_in AS (SELECT count(*) AS a, count(o_totalprice) AS b FROM {ORDERS_WITH_NULLS}),
    totals AS (SELECT count(*) AS d FROM (
        SELECT DISTINCT c_mktsegment, o_totalprice > 100000
        FROM {ORDERS_WITH_NULLS} LEFT JOIN customer ON o_custkey = c_custkey
        WHERE o_totalprice IS NOT NULL)),
    run AS (
        SELECT 1 AS step, 'Remove nulls' AS transformation, ['orders'] AS inputs,
               'priced' AS output, a AS rows_in, b AS rows_out, 5 AS cols FROM orders_in
        UNION ALL SELECT 2, 'Lookup', ['priced', 'customers'], 'named', b, b, 7 FROM orders_in
        UNION ALL SELECT 3, 'Validate', ['named'], 'checked', b, b, 9 FROM orders_in
        UNION ALL SELECT 4, 'Group by', ['checked'], 'totals', b, d, 3 FROM orders_in, totals)
"""


def _run(spark, sf_dir, measure=True):
    workspace = Workspace(spark)
    workspace.add("orders", orders_with_nulls(spark, sf_dir))
    workspace.add(
        "customers",
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"),
    )
    return run_steps(workspace, _STEPS, measure)


@query(
    "step_summary",
    _STEP_ROWS
    + """SELECT step, transformation, array_to_string(inputs, ', ') AS input, output,
                rows_out AS "rows", cols AS columns FROM run""",
)
def step_summary(spark, sf_dir):
    return st.results_summary(_run(spark, sf_dir).steps())


@query(
    "step_result",
    f"""SELECT c_mktsegment, o_totalprice > 100000 AS is_large,
               round(sum(o_totalprice), 2) AS o_totalprice_sum
        FROM {ORDERS_WITH_NULLS} LEFT JOIN customer ON o_custkey = c_custkey
        WHERE o_totalprice IS NOT NULL GROUP BY 1, 2""",
)
def step_result(spark, sf_dir):
    result = _run(spark, sf_dir, measure=False).result
    return result.withColumn("o_totalprice_sum", F.round("o_totalprice_sum", 2))


@query(
    "record_impact",
    _STEP_ROWS
    + """SELECT step, transformation, rows_in AS input_rows, rows_out AS output_rows,
                round((rows_out - rows_in) * 100.0 / rows_in, 1) AS change_percentage FROM run""",
)
def record_impact(spark, sf_dir):
    return st.record_impact(_run(spark, sf_dir).steps())


@query(
    "throughput",
    _STEP_ROWS
    + """SELECT count(*) AS transformations, sum(rows_in)::BIGINT AS total_input_rows,
                sum(rows_out)::BIGINT AS total_output_rows,
                round(sum(rows_out) * 100.0 / sum(rows_in), 1) AS efficiency FROM run""",
)
def throughput(spark, sf_dir):
    return st.throughput(_run(spark, sf_dir).steps())


@query(
    "step_change",
    _STEP_ROWS
    + """SELECT step, transformation, inputs[1] AS input_dataset, output AS output_dataset,
                previous AS previous_rows, rows_out AS output_rows,
                rows_out - previous AS change,
                round((rows_out - previous) * 100.0 / previous, 1) AS change_percentage,
                CASE WHEN previous IS NOT NULL THEN
                    printf('%+d (%+.1f%%)', rows_out - previous,
                           round((rows_out - previous) * 100.0 / previous, 1)) END AS data_change
         FROM (SELECT *, lag(rows_out) OVER (ORDER BY step) AS previous FROM run)""",
)
def step_change(spark, sf_dir):
    return st.step_change(_run(spark, sf_dir).steps())


@query(
    "volume_series",
    _STEP_ROWS
    + """SELECT step, 'input' AS kind, rows_in AS "rows" FROM run
         UNION ALL SELECT step, 'output', rows_out FROM run""",
)
def volume_series(spark, sf_dir):
    return st.volume_series(_run(spark, sf_dir).steps())


@query(
    "run_statistics",
    _STEP_ROWS
    + """SELECT count(*) AS steps, 'orders' AS start_dataset, 'totals' AS final_dataset
         FROM run""",
)
def run_statistics(spark, sf_dir):
    return st.run_statistics(_run(spark, sf_dir).steps()).select(
        "steps", "start_dataset", "final_dataset"
    )


@query(
    "step_timing_order",
    _STEP_ROWS + "SELECT step, transformation, true AS timed, rows_in AS input_rows FROM run",
)
def step_timing_order(spark, sf_dir):
    """Every measured step has a time, and a rate that agrees with it and its rows."""
    steps = _run(spark, sf_dir).steps()
    timed = st.step_timing(steps).join(steps.select("step", "input_rows"), "step")
    rate = F.round(F.col("input_rows") * 1000.0 / F.col("elapsed_ms"), 1)
    right = (F.col("elapsed_ms") >= 0) & F.when(
        F.col("elapsed_ms") > 0, F.col("rows_per_second") == rate
    ).otherwise(F.col("rows_per_second").isNull())
    return timed.select("step", "transformation", right.alias("timed"), "input_rows")


@query("step_timing")
def step_timing(spark, sf_dir):
    return st.step_timing(_run(spark, sf_dir).steps())


@query(
    "schema_evolution",
    _STEP_ROWS
    + """SELECT step, change, count(*) AS columns, any_value(rows_out) AS output_rows FROM run JOIN (
            SELECT unnest([1, 1, 1, 1, 1, 2, 2, 2, 2, 2, 2, 2, 3, 3, 3, 3, 3, 3, 3, 3, 3,
                           4, 4, 4, 4, 4, 4, 4, 4, 4, 4]) AS s,
                   unnest(['preserved', 'preserved', 'preserved', 'preserved', 'preserved',
                           'preserved', 'preserved', 'preserved', 'preserved', 'preserved',
                           'added', 'added',
                           'preserved', 'preserved', 'preserved', 'preserved', 'preserved',
                           'preserved', 'preserved', 'added', 'added',
                           'preserved', 'preserved', 'added', 'removed', 'removed', 'removed',
                           'removed', 'removed', 'removed', 'removed']) AS change)
         ON s = step GROUP BY step, change""",
)
def schema_evolution(spark, sf_dir):
    run = _run(spark, sf_dir)
    rows = run.steps().select("step", "output_rows")
    return (
        run.schema_evolution()
        .groupBy("step", "change")
        .agg(F.count(F.lit(1)).alias("columns"))
        .join(rows, "step")
    )


@query(
    "flow_links",
    _STEP_ROWS
    + """SELECT unnest(inputs) AS source, output AS target, rows_out AS value,
                transformation AS label FROM run""",
)
def flow_links(spark, sf_dir):
    return st.flow_links(_run(spark, sf_dir).steps())


@query(
    "flow_links_via_steps",
    _STEP_ROWS
    + """SELECT unnest(inputs) AS source, transformation AS target, rows_out AS value FROM run
         UNION ALL SELECT transformation, output, rows_out FROM run""",
)
def flow_links_via_steps(spark, sf_dir):
    return st.flow_links_via_steps(_run(spark, sf_dir).steps())


@query(
    "step_graph",
    _STEP_ROWS
    + """SELECT unnest(inputs) AS src, output AS dst, transformation, rows_out AS value FROM run""",
)
def step_graph(spark, sf_dir):
    steps = _run(spark, sf_dir).steps()
    _, edges = st.step_graph(steps)
    sizes = steps.select(F.col("output_name").alias("dst"), F.col("output_rows").alias("value"))
    return edges.join(sizes, "dst")


# --- exports ----------------------------------------------------------------------


@query(
    "export_manifest",
    _STEP_ROWS
    + """SELECT 'dataset' AS kind, output AS name, rows_out AS "rows" FROM run
         UNION ALL SELECT 'dataset', 'orders', a FROM orders_in
         UNION ALL SELECT 'dataset', 'customers', count(*) FROM customer
         UNION ALL SELECT 'sample', output, least(rows_out, 100) FROM run
         UNION ALL SELECT 'sample', 'orders', least(a, 100) FROM orders_in
         UNION ALL SELECT 'sample', 'customers', least(count(*), 100) FROM customer
         UNION ALL SELECT 'steps', unnest(['execution_results', 'execution_summary']), 4
         UNION ALL SELECT 'quality', 'orders', 1""",
)
def export_manifest(spark, sf_dir):
    run = _run(spark, sf_dir)
    tables = run.workspace.tables
    folder = new_folder(spark, "export")
    written = w.export_tables(tables, folder)
    written += w.export_steps(run.steps(), folder)
    written += w.export_quality({"orders": tables["orders"]}, folder)
    w.export_manifest(spark, written, folder)
    back = read_table(spark, f"{folder}/manifest", "json", schema=w.MANIFEST)
    return back.select("kind", "name", "rows")


@query(
    "export_spec",
    _STEP_ROWS
    + """SELECT step::BIGINT AS step, transformation, output AS output_name,
                rows_out AS expected_rows, cols::BIGINT AS expected_columns FROM run""",
)
def export_spec(spark, sf_dir):
    path = new_folder(spark, "spec")
    steps = _run(spark, sf_dir).steps()
    w.export_spec(spark, steps, {"orders": {"path": f"{sf_dir}/orders.parquet"}}, path)
    return read_table(spark, path, "json").select(
        "step", "transformation", "output_name", "expected_rows", "expected_columns"
    )


@query("export_graph_links", _PROVENANCE + "SELECT src, dst, edge_type FROM edge")
def export_graph_links(spark, sf_dir):
    folder = new_folder(spark, "export")
    w.export_graph(*_graph(spark, sf_dir), folder)
    return read_table(spark, f"{folder}/graph/links", "json").select("src", "dst", "edge_type")


@query(
    "export_quality",
    f"""SELECT 'with_nulls' AS dataset, count(*) AS total_rows, 0::BIGINT AS duplicate_count
        FROM {ORDERS_WITH_NULLS}""",
)
def export_quality(spark, sf_dir):
    folder = new_folder(spark, "export")
    w.export_quality({"with_nulls": orders_with_nulls(spark, sf_dir)}, folder)
    return read_table(spark, f"{folder}/quality_reports/with_nulls", "json").select(
        "dataset", "total_rows", "duplicate_count"
    )


# --- files ------------------------------------------------------------------------


@query(
    "load_catalogue",
    """SELECT 'part' AS name, count(*) AS "rows" FROM part
       UNION ALL SELECT 'customer', count(*) FROM customer
       UNION ALL SELECT 'orders', count(*) FROM orders""",
)
def load_catalogue(spark, sf_dir):
    folder = new_folder(spark, "catalogue")
    kinds = {"part": "csv", "customer": "json", "orders": "parquet"}
    for name, kind in kinds.items():
        write_table(table(spark, sf_dir, name), f"{folder}/{name}", kind)
    catalogue = {n: {"path": f"/{n}", "format": k} for n, k in kinds.items()}
    catalogue["missing"] = {"path": "/missing", "format": "parquet"}
    loaded = Workspace(spark).load_all(catalogue, folder)
    counts = [
        row_count(df).select(F.lit(name).alias("name"), "rows") for name, df in loaded.items()
    ]
    return union_tables(counts, "union_all")


@query(
    "stage_handoff",
    """SELECT o_orderpriority, count(*) AS orders FROM orders WHERE o_orderstatus = 'F'
       GROUP BY o_orderpriority""",
)
def stage_handoff(spark, sf_dir):
    folder = new_folder(spark, "stages")
    closed = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    write_table(closed, f"{folder}/closed", "parquet")
    return (
        read_stage(spark, folder, "closed")
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query(
    "roundtrip_csv",
    "SELECT doc_id, lang, n_chars, length(text)::INTEGER AS length, md5(text) AS digest FROM documents",
)
def roundtrip_csv(spark, sf_dir):
    folder = new_folder(spark, "roundtrip")
    write_table(table(spark, sf_dir, "documents"), folder, "csv")
    schema = table(spark, sf_dir, "documents").schema
    back = read_table(spark, folder, "csv", schema=schema)
    return back.select(
        "doc_id", "lang", "n_chars", F.length("text").alias("length"), F.md5("text").alias("digest")
    )


@query(
    "roundtrip_csv_inferred",
    "SELECT l_returnflag, count(*) AS lines, round(sum(l_quantity), 2) AS quantity "
    "FROM lineitem GROUP BY l_returnflag",
)
def roundtrip_csv_inferred(spark, sf_dir):
    folder = new_folder(spark, "roundtrip")
    write_table(table(spark, sf_dir, "lineitem"), folder, "csv")
    workspace = Workspace(spark)
    back = workspace.load("lines", folder)
    return back.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query(
    "roundtrip_json",
    "SELECT conv_id, turn, role, md5(text) AS digest FROM conversations",
)
def roundtrip_json(spark, sf_dir):
    folder = new_folder(spark, "roundtrip")
    write_table(table(spark, sf_dir, "conversations"), folder, "json")
    back = read_table(spark, folder, "json")
    return back.select("conv_id", "turn", "role", F.md5("text").alias("digest"))


@query(
    "roundtrip_parquet",
    "SELECT l_returnflag, l_linestatus, 2 * count(*) AS lines, round(2 * sum(l_extendedprice), 2) AS price "
    "FROM lineitem GROUP BY ALL",
)
def roundtrip_parquet(spark, sf_dir):
    folder = new_folder(spark, "roundtrip")
    lines = table(spark, sf_dir, "lineitem")
    write_table(lines, folder, "parquet")
    write_table(lines, folder, "parquet", "append")
    back = read_table(spark, folder, "parquet")
    return back.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
    )
