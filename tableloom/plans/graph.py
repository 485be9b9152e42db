"""The provenance graph as two tables, and questions about it.

Reachability walks the graph in rounds. A round joins the newest nodes to the
edges and writes what it found next to the earlier rounds, so a round reads
plain files, never the plans of the rounds before, and a lost executor costs
that round only. Files of many rounds are merged, eight of a size at a time.

Which sinks a node leads to is kept as bits, 64 sinks to a row, and only for
nodes that a source leads to. Pairs of source and sink appear in the result
alone: paths go from node to node for all sinks of a row that share them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sizing import dealt_partitions_for
from ..functions.storage import new_folder, store

NODE_PREFIX = "transform_"

# When a name plays several roles the lowest number wins.
ROLE_ORDER = {"transformation": 0, "sink": 1, "source": 2, "intermediate": 3}


def build_edges(
    provenance: Mapping[str, DataFrame],
    include_dependency_edges: bool = True,
    names: DataFrame | None = None,
) -> DataFrame:
    """(src, dst, edge_type, transformation_id), one row per connected pair.

    Stated dependencies count between known nodes only; ``names`` is the node
    table if there is one already.
    """
    steps = _dealt(provenance["transformations"].select("id", "input_tables", "output_table"))
    node, made = F.concat(F.lit(NODE_PREFIX), "id"), F.col("output_table")
    edges = steps.select(
        F.inline(
            F.concat(
                F.transform(_inputs(), lambda read: _edge(read, node, "consumes")),
                F.array(_edge(node, made, "produces")),
            )
        )
    )
    if include_dependency_edges:
        known = typed_names(provenance) if names is None else names
        stated = _dealt(provenance["dependencies"].select("source", "target", "transformation_id")).select(
            F.col("source").alias("src"),
            F.col("target").alias("dst"),
            F.lit("dependency").alias("edge_type"),
            "transformation_id",
        )
        for end in ("src", "dst"):
            # A table of all names is no small side, though its files may look like one. A semi join
            # would be moved below the dealing, back into the tasks that read whole files; names
            # that come twice are merged with the edges.
            stated = stated.join(known.select(F.col("name").alias(end)).hint("merge"), end)
        edges = edges.unionByName(stated)
    # A stated dependency never replaces the edge of a step.
    rank = F.when(F.col("edge_type") == "dependency", 1).otherwise(0)
    return (
        edges.groupBy("src", "dst")
        .agg(F.min(F.struct(rank, "edge_type", "transformation_id")).alias("first"))
        .select("src", "dst", "first.edge_type", "first.transformation_id")
    )


def typed_names(provenance: Mapping[str, DataFrame]) -> DataFrame:
    """(name, node_type, label) of every node, by its most important role."""
    return (
        _named(provenance)
        .groupBy("name")
        .agg(F.min(F.struct("role", "node_type", "label")).alias("first"))
        .select("name", "first.node_type", "first.label")
    )


def _named(provenance: Mapping[str, DataFrame]) -> DataFrame:
    """Every name with every role it plays."""
    steps = _dealt(provenance["transformations"].select("id", "name", "input_tables", "output_table"))

    def role(name, kind: str, label=None) -> Column:
        return F.struct(
            name.alias("name"),
            F.lit(ROLE_ORDER[kind]).alias("role"),
            F.lit(kind).alias("node_type"),
            (name if label is None else label).alias("label"),
        )

    step = role(F.concat(F.lit(NODE_PREFIX), "id"), "transformation", F.col("name"))
    made = role(F.col("output_table"), "intermediate")
    read = F.transform(_inputs(), lambda table: role(table, "intermediate"))
    return reduce(
        DataFrame.unionByName,
        [
            _dealt(provenance["data_sources"].select("name")).select(role(F.col("name"), "source").alias("r")).select("r.*"),
            _dealt(provenance["data_sinks"].select("name")).select(role(F.col("name"), "sink").alias("r")).select("r.*"),
            steps.select(F.inline(F.concat(F.array(step, made), read))),
        ],
    )


DEALT_BYTES = 4 << 20
"""Bytes of record files a task should stand for: they are compressed, and a record makes several rows."""


def _dealt(records: DataFrame) -> DataFrame:
    """``records`` over many tasks, more for large input, however few files they come in.

    What is made of them is sorted by name, and a task that reads a whole file
    would sort all of it.
    """
    return records.repartition(dealt_partitions_for(records, DEALT_BYTES), *records.columns)


def _inputs() -> Column:
    return F.coalesce("input_tables", F.array().cast("array<string>"))


def _edge(src: Column, dst: Column, kind: str) -> Column:
    return F.struct(
        src.alias("src"), dst.alias("dst"), F.lit(kind).alias("edge_type"), F.col("id").alias("transformation_id")
    )


def build_graph(
    provenance: Mapping[str, DataFrame], include_dependency_edges: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges); nodes carry their type, label and degrees.

    Every question reads both tables, most of them more than once, so they are
    written to the shared folder and come back as plain scans.
    """
    typed = store(typed_names(provenance), "provenance-names")
    edges = store(
        build_edges(provenance, include_dependency_edges, typed), "provenance-edges"
    )
    counted = degrees(edges).select("name", "in_degree", "out_degree")
    nodes = typed.join(counted.hint("merge"), "name", "left").na.fill(
        0, ["in_degree", "out_degree"]
    )
    return store(nodes, "provenance-nodes"), edges


def degrees(edges: DataFrame) -> DataFrame:
    """In and out degree of every connected node and the role they give it."""
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("name"), F.lit(0).alias("i"), F.lit(1).alias("o")),
                F.struct(F.col("dst").alias("name"), F.lit(1).alias("i"), F.lit(0).alias("o")),
            )
        )
    )
    return (
        ends.groupBy("name")
        .agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
        .withColumn(
            "dataset_role",
            F.when(F.col("in_degree") == 0, "source")
            .when(F.col("out_degree") == 0, "final")
            .otherwise("intermediate"),
        )
    )


MERGED = 8
"""Files of rounds that are merged into one folder."""


def _rounds(first: DataFrame, step, label: str) -> DataFrame:
    """All rows of ``first`` and of the rounds after it, up to one that finds nothing.

    ``step(newest, seen, depth)`` makes round ``depth`` of the newest round and of
    all rounds before. Eight folders of one size become one, so there are few of
    them, and a row is copied as often as the number of rounds has octal digits.
    """
    spark, schema, folder = first.sparkSession, first.schema, new_folder(first.sparkSession, label)
    parts: list[tuple[int, str]] = []

    def read(paths: list[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(*paths)

    depth, found = 0, first
    while True:
        newest = f"{folder}/round={depth}"
        found.write.parquet(newest)
        if read([newest]).isEmpty():
            return read([*(path for _, path in parts), newest])
        parts.append((0, newest))
        depth += 1
        found = step(read([newest]), read([path for _, path in parts]), depth)
        size = parts[-1][0]
        while [level for level, _ in parts[-MERGED:]] == [size] * MERGED:
            merged = f"{folder}/merged={depth}-{size}"
            # The newest round stays on its own until the next one is made of it.
            read([path for _, path in parts[-MERGED:]]).write.parquet(merged)
            parts[-MERGED:] = [(size + 1, merged)]
            size += 1


def walk(edges: DataFrame, seeds: DataFrame, with_path: bool = False) -> DataFrame:
    """Everything reachable from each root: (root, node, distance[, path]).

    ``seeds`` has one column ``root``. Paths are shortest, and among those the
    first in dictionary order. A root reaches itself at distance 0. Every round
    reads ``edges``: pass written tables, as ``build_graph`` returns them. There
    is a row for every root and node it reaches; for the pairs of sources and
    sinks alone take ``reachable_pairs`` or ``flow_paths``.
    """
    steps = edges.select("src", "dst")
    path = F.array("root") if with_path else F.lit(None).cast("array<string>")
    first = seeds.select("root").distinct().select(
        "root", F.col("root").alias("node"), F.lit(0).alias("distance"), path.alias("path")
    )
    extended = F.concat("path", F.array("dst")) if with_path else F.col("path")

    def step(newest: DataFrame, seen: DataFrame, depth: int) -> DataFrame:
        return (
            newest.join(steps, newest["node"] == steps["src"])
            .select("root", F.col("dst").alias("node"), extended.alias("path"))
            .groupBy("root", "node")
            .agg(F.min("path").alias("path"))
            .join(seen.select("root", "node"), ["root", "node"], "left_anti")
            .select("root", "node", F.lit(depth).alias("distance"), "path")
        )

    reached = _rounds(first, step, "graph-walk")
    return reached if with_path else reached.drop("path")


def reached(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(node, distance) of every node that any of ``seeds`` (column ``node``) leads to.

    One row per node, however many seeds lead to it; seeds have distance 0.
    """
    steps = edges.select("src", "dst")

    def step(newest: DataFrame, seen: DataFrame, depth: int) -> DataFrame:
        return (
            newest.join(steps, newest["node"] == steps["src"])
            .select(F.col("dst").alias("node"))
            .distinct()
            .join(seen.select("node"), "node", "left_anti")
            .select("node", F.lit(depth).alias("distance"))
        )

    first = seeds.select("node").distinct().withColumn("distance", F.lit(0))
    return _rounds(first, step, "graph-reached")


def reversed_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def downstream(edges: DataFrame, name: str) -> DataFrame:
    """Nodes that depend on ``name``, with their distance."""
    return _around(edges, name)


def upstream(edges: DataFrame, name: str) -> DataFrame:
    """Nodes that ``name`` depends on, with their distance."""
    return _around(reversed_edges(edges), name)


def _around(edges: DataFrame, name: str) -> DataFrame:
    seed = edges.sparkSession.createDataFrame([(name,)], "node string")
    return reached(edges, seed).filter(F.col("node") != name)


def impact(
    nodes: DataFrame, edges: DataFrame, name: str
) -> tuple[DataFrame, DataFrame]:
    """(nodes with their role towards ``name``, edges among them)."""
    if nodes.filter(F.col("name") == name).isEmpty():
        raise ValueError(f"node {name} is not in the provenance graph")
    spark = edges.sparkSession
    rows = reduce(
        DataFrame.unionByName,
        [
            spark.createDataFrame([(name,)], "node string").withColumn("role", F.lit("0selected")),
            upstream(edges, name).select("node", F.lit("1upstream").alias("role")),
            downstream(edges, name).select("node", F.lit("2downstream").alias("role")),
        ],
    )
    related = (
        rows.groupBy("node")
        .agg(F.min("role").alias("role"))
        .select("node", F.substring("role", 2, 20).alias("role"))
    )
    among = edges
    for end in ("src", "dst"):
        among = among.join(
            related.select(F.col("node").alias(end)), end, "left_semi"
        )
    return related, among.select(*edges.columns)


def _of_type(nodes: DataFrame, kind: str, name: str) -> DataFrame:
    return nodes.filter(F.col("node_type") == kind).select(F.col("name").alias(name))


def _without_detours(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Different (src, dst), less those of nodes that no shortest path leads through.

    A node with one way out is left out where all that leads to it also leads
    straight to where it leads, as with steps whose dependencies are stated too.
    Sources and sinks stay. An edge is looked at once, however many lead to a node.
    """
    links = store(edges.select("src", "dst").distinct(), "graph-links")
    ends = nodes.filter(F.col("node_type").isin("source", "sink")).select(F.col("name").alias("src"))
    single = links.groupBy("src").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").join(ends, "src", "left_anti")
    onward = links.join(single.select("src"), "src", "left_semi").select(
        F.col("src").alias("dst"), F.col("dst").alias("after")
    )
    straight = links.select("src", F.col("dst").alias("after"), F.lit(1).alias("straight"))
    detours = store(
        links.join(onward, "dst")
        .join(straight, ["src", "after"], "left")
        .groupBy("dst")
        .agg(F.count(F.lit(1)).alias("n"), F.count("straight").alias("s"))
        .filter("n = s")
        .select("dst"),
        "graph-detours",
    )
    return store(
        links.join(detours.hint("merge"), "dst", "left_anti")
        .join(detours.select(F.col("dst").alias("src")).hint("merge"), "src", "left_anti")
        .select("src", "dst"),
        "graph-links",
    )


class _Distances:
    """How far nodes that a source leads to are from the sinks they lead to.

    ``sinks``: (block, sinks), the bits and names of 64 sinks. ``rows``: (node,
    block, distance, bits), where bit ``i`` says that the sink of that block and bit
    is at that distance. With ``hops`` they also have ``dst``, the first neighbour by
    name that is one step nearer, and a node has a row for each of these.
    ``steps``: (src, dst) among nodes that a source leads to.
    """

    def __init__(self, nodes: DataFrame, edges: DataFrame, hops: bool = False):
        links = _without_detours(nodes, edges)
        ahead = reached(links, _of_type(nodes, "source", "node")).select(F.col("node").alias("src"))
        self.steps = store(links.join(ahead.hint("merge"), "src", "left_semi"), "graph-steps")
        # Neighbours by name often follow the same nodes, so their bits share rows.
        ordered = _of_type(nodes, "sink", "sink").repartitionByRange("sink").sortWithinPartitions("sink")
        number = F.monotonically_increasing_id()
        numbered = store(
            ordered.select("sink", F.shiftright(number, 6).alias("block"), (number % 64).cast("int").alias("bit")),
            "graph-sinks",
        )
        self.sinks = numbered.groupBy("block").agg(F.collect_list(F.struct("bit", "sink")).alias("sinks"))
        first = numbered.groupBy(F.col("sink").alias("node"), "block").agg(
            F.lit(0).alias("distance"), F.expr("bit_or(shiftleft(1L, bit))").alias("bits")
        )

        def step(newest: DataFrame, seen: DataFrame, depth: int) -> DataFrame:
            # New and known bits meet in one aggregate: neither is sorted for a join.
            none = F.lit(0).cast("bigint")
            found = newest.join(self.steps, newest["node"] == self.steps["dst"]).select(
                F.col("src").alias("node"), "block", "bits", none.alias("known")
            )
            known = seen.select("node", "block", none.alias("bits"), F.col("bits").alias("known"))
            return (
                found.unionByName(known)
                .groupBy("node", "block")
                .agg(F.bit_or("bits").alias("bits"), F.bit_or("known").alias("known"))
                .select("node", "block", F.lit(depth).alias("distance"), F.expr("bits & ~known").alias("bits"))
                .filter("bits != 0")
            )

        def hop(newest: DataFrame, seen: DataFrame, depth: int) -> DataFrame:
            known = seen.groupBy("node", "block").agg(F.bit_or("bits").alias("known"))
            nearer = newest.groupBy(F.col("node").alias("dst"), "block").agg(F.bit_or("bits").alias("bits"))
            before = Window.partitionBy("node", "block").orderBy("dst").rowsBetween(Window.unboundedPreceding, -1)
            return (
                nearer.join(self.steps, "dst")
                .select(F.col("src").alias("node"), "block", "dst", "bits")
                .join(known, ["node", "block"], "left")
                .withColumn("bits", F.expr("bits & ~coalesce(known, 0L)"))
                .filter("bits != 0")
                .withColumn("taken", F.bit_or("bits").over(before))
                .withColumn("bits", F.expr("bits & ~coalesce(taken, 0L)"))
                .filter("bits != 0")
                .select("node", "block", F.lit(depth).alias("distance"), "bits", "dst")
            )

        if hops:
            first = first.withColumn("dst", F.lit(None).cast("string"))
        self.rows = _rounds(first, hop if hops else step, "graph-distances")

    def of_sources(self, nodes: DataFrame) -> DataFrame:
        return (
            self.rows.join(_of_type(nodes, "source", "node"), "node", "left_semi")
            .groupBy("node", "block", "distance")
            .agg(F.bit_or("bits").alias("bits"))
        )

    def named(self, groups: DataFrame) -> DataFrame:
        """``groups`` (``block``, ``bits``, ...), a row for each sink in the bits, as ``sink``."""
        chosen = F.expr("filter(sinks, s -> bits & shiftleft(1L, s.bit) != 0)")
        named = groups.join(self.sinks, "block").withColumn("one", F.explode(chosen))
        return named.withColumn("sink", F.col("one.sink")).drop("one", "sinks")


def reachable_pairs(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(source, sink, length) for every sink a source leads to."""
    distances = _Distances(nodes, edges)
    return distances.named(distances.of_sources(nodes)).select(
        F.col("node").alias("source"), "sink", F.col("distance").alias("length")
    )


def flow_paths(nodes: DataFrame, edges: DataFrame, with_types: bool = False) -> DataFrame:
    """(source, sink, path, length): one shortest path per connected pair.

    Among shortest paths it is the first in dictionary order: from each node the
    path goes on to the first neighbour by name that is one step nearer. Sinks of
    a block go together as long as their paths do, and those come last that are
    nearest, so that each distance's rows are read once. ``with_types`` adds
    ``node_types``, the types of the path's nodes.
    """
    distances = _Distances(nodes, edges, hops=True)
    started = distances.of_sources(nodes)
    onward = distances.rows.filter("distance > 1")
    source, sink, kind = F.lit("source"), F.lit("sink"), F.lit(None).cast("string")
    if with_types:
        kinds = nodes.select(F.col("name").alias("dst"), F.col("node_type").alias("kind"))
        onward = store(onward.join(kinds, "dst", "left"), "graph-hops")
        kind = F.col("kind")
    started = store(started, "graph-starts").select(
        F.col("node").alias("source"), "node", "block", "bits", F.col("distance").alias("length"),
        F.array("node").alias("path"), F.array(source).alias("node_types"),
    )
    longest = started.agg(F.max("length")).first()[0] or 0

    def begun(length: int) -> DataFrame:
        return started.filter(F.col("length") == length)

    def grown(groups: DataFrame, node: Column, kind: Column) -> DataFrame:
        path, kinds = F.concat("path", F.array(node)), F.concat("node_types", F.array(kind))
        return groups.withColumns({"path": path, "node_types": kinds if with_types else F.col("node_types")})

    walking = begun(longest)
    for left in range(longest, 1, -1):
        ahead = onward.filter(F.col("distance") == left).withColumnRenamed("bits", "others").drop("distance")
        split = walking.join(ahead, ["node", "block"]).withColumn("bits", F.expr("bits & others")).filter("bits != 0")
        moved = grown(split, F.col("dst"), kind).withColumn("node", F.col("dst")).select(started.columns)
        walking = store(moved, "graph-paths").union(begun(left - 1))
    ended = distances.named(walking)
    if longest:
        ended = grown(ended, F.col("sink"), sink).unionByName(distances.named(begun(0)))
    return ended.select("source", "sink", "path", "length", *(["node_types"] if with_types else []))


def path_positions(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """(source, sink, position, node, node_type) along every flow path.

    Types that came with the paths are taken from there; else each node of a path
    looks for its own.
    """
    if "node_types" in paths.columns:
        along = F.posexplode(F.arrays_zip("path", "node_types")).alias("position", "at")
        return paths.select("source", "sink", along).select(
            "source", "sink", "position", F.col("at.path").alias("node"), F.col("at.node_types").alias("node_type")
        )
    return (
        paths.select("source", "sink", F.posexplode("path").alias("position", "name"))
        .join(nodes.select("name", "node_type"), "name")
        .select("source", "sink", "position", F.col("name").alias("node"), "node_type")
    )


def node_type_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("node_type").agg(F.count(F.lit(1)).alias("nodes"))


def transformation_counts(provenance: Mapping[str, DataFrame]) -> DataFrame:
    """How often each transformation was used."""
    return provenance["transformations"].groupBy("name").agg(F.count(F.lit(1)).alias("uses"))


def most_connected(nodes: DataFrame) -> DataFrame:
    """The node with the most edges, by name among equals."""
    return (
        nodes.select("name", (F.col("in_degree") + F.col("out_degree")).alias("degree"))
        .orderBy(F.desc("degree"), "name")
        .limit(1)
    )


def graph_statistics(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: counts, flow paths, longest of them, busiest node, uses by name."""

    def of_type(kind: str):
        return F.count_if(F.col("node_type") == kind)

    counts = nodes.agg(
        F.count(F.lit(1)).alias("total_nodes"),
        of_type("source").alias("data_sources"),
        of_type("sink").alias("data_sinks"),
        of_type("intermediate").alias("intermediate_datasets"),
        of_type("transformation").alias("transformations"),
    )
    # Pairs are counted by their bits, never listed.
    pairs = _Distances(nodes, edges).of_sources(nodes).agg(
        F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias("flow_paths"),
        F.coalesce(F.max("distance"), F.lit(0)).alias("max_shortest_path"),
    )
    pair = pairs.select(F.struct(*pairs.columns)).scalar()
    uses = (
        nodes.filter("node_type = 'transformation'")
        .groupBy(F.col("label").alias("name"))
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    # As long as the list of the operators in use.
    listed = uses.agg(F.sort_array(F.collect_list(F.struct("name", "uses"))))
    return counts.select(
        "*",
        edges.agg(F.count(F.lit(1))).scalar().alias("total_edges"),
        pair["flow_paths"].alias("flow_paths"),
        pair["max_shortest_path"].alias("max_shortest_path"),
        most_connected(nodes).select("name").scalar().alias("most_connected_node"),
        listed.scalar().alias("transformation_types"),
    )


def dependency_matrix(
    edges: DataFrame, labels: Sequence[str] | None = None
) -> DataFrame:
    """The adjacency matrix: its ones as (source, target, connected), the rest is 0.

    With ``labels`` the full 0/1 square over these nodes, one column per target.
    """
    ones = edges.select(
        F.col("src").alias("source"), F.col("dst").alias("target"), F.lit(1).alias("connected")
    ).distinct()
    if labels is None:
        return ones
    names = list(labels)
    rows = edges.sparkSession.createDataFrame([(n,) for n in names], "source string")
    square = ones.groupBy("source").pivot("target", names).agg(F.max("connected"))
    return rows.join(square, "source", "left").na.fill(0)


def adjacency(dependencies: DataFrame) -> DataFrame:
    """(source, target): every pair once, however many targets a source has."""
    return dependencies.select("source", "target").distinct()
