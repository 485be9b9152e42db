import pytest
from pyspark.sql import functions as F

from tableloom.catalog.tracing import provenance_of_parts
from tableloom.plans import graph as g
from tableloom.plans.provenance import (
    ProvenanceLog,
    consolidate,
    overview,
    read_provenance,
    transformation_listing,
)


def visits_log():
    """Two sources, four steps, three tables in between, one result."""
    log = ProvenanceLog("run")
    log.add_source("people_file", "csv", "in/people.csv")
    log.add_source("visits_file", "csv", "in/visits.csv")
    log.add_transformation("Deduplicate", ["people_file"], "people")
    log.add_transformation("KeepPaid", ["visits_file"], "visits", metadata={"input_rows": 9, "output_rows": 7})
    log.add_transformation("Attach", ["people", "visits"], "visits_of_people")
    log.add_transformation("CountVisits", ["visits_of_people"], "visit_counts")
    log.add_sink("visit_counts", "parquet", "out/visit_counts")
    return log


@pytest.fixture(scope="module")
def provenance(spark):
    return visits_log().tables(spark)


@pytest.fixture(scope="module")
def graph(provenance):
    return g.build_graph(provenance)


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_statistics_with_dependencies(graph):
    row = g.graph_statistics(*graph).first()
    assert (row.total_nodes, row.total_edges) == (10, 14)
    assert (row.data_sources, row.data_sinks, row.intermediate_datasets, row.transformations) == (2, 1, 3, 4)
    assert (row.flow_paths, row.max_shortest_path) == (2, 3)
    assert row.most_connected_node == "visits_of_people"
    kinds = dict(pairs(graph[1].groupBy("edge_type").count()))
    assert kinds == {"consumes": 5, "produces": 4, "dependency": 5}


def test_statistics_through_steps(provenance):
    nodes, edges = g.build_graph(provenance, include_dependency_edges=False)
    row = g.graph_statistics(nodes, edges).first()
    assert (row.total_edges, row.max_shortest_path) == (9, 6)
    busiest = g.most_connected(nodes).first()
    assert (busiest.name, busiest.degree) == ("transform_run_3", 3)


def test_paths(graph):
    nodes, edges = graph
    paths = g.flow_paths(nodes, edges)
    assert {r.source: r.path for r in paths.collect()} == {
        "people_file": ["people_file", "people", "visits_of_people", "visit_counts"],
        "visits_file": ["visits_file", "visits", "visits_of_people", "visit_counts"],
    }
    places = g.path_positions(paths, nodes).filter("source = 'visits_file'").orderBy("position")
    assert [r.node_type for r in places.collect()] == ["source", "intermediate", "intermediate", "sink"]
    assert pairs(g.reachable_pairs(nodes, edges)) == [
        ("people_file", "visit_counts", 3), ("visits_file", "visit_counts", 3),
    ]


def test_impact(graph):
    nodes, edges = graph
    related, among = g.impact(nodes, edges, "visits")
    roles = {r.node: r.role for r in related.collect()}
    assert roles["visits"] == "selected" and roles["visits_file"] == "upstream"
    assert roles["visit_counts"] == "downstream" and "people_file" not in roles
    assert among.filter("src = 'people' OR dst = 'people'").count() == 0
    assert among.columns == edges.columns
    with pytest.raises(ValueError):
        g.impact(nodes, edges, "nobody")


def test_degrees_and_counts(graph, provenance):
    nodes, edges = graph
    roles = {r.name: r.dataset_role for r in g.degrees(edges).collect()}
    assert roles["visits_file"] == "source" and roles["visit_counts"] == "final"
    assert dict(pairs(g.node_type_counts(nodes)))["intermediate"] == 3
    assert dict(pairs(g.transformation_counts(provenance)))["Attach"] == 1


def test_matrix(graph):
    square = g.dependency_matrix(graph[1], ["visits_file", "visits", "visits_of_people"])
    assert {r.source: tuple(r)[1:] for r in square.collect()} == {
        "visits_file": (0, 1, 0), "visits": (0, 0, 1), "visits_of_people": (0, 0, 0),
    }
    assert g.dependency_matrix(graph[1]).count() == 14


def test_adjacency_holds_every_pair_once(spark):
    edges = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, "hub").otherwise(F.concat(F.lit("s"), F.col("id") % 20)).alias("source"),
        F.concat(F.lit("t"), "id").alias("target"),
    )
    assert pairs(g.adjacency(edges.union(edges))) == pairs(edges)


def test_walk_with_cycles_and_hubs(spark):
    """Against a plain breadth-first search; a third of all edges leave one hub."""
    edges = [("hub", f"n{i}") for i in range(40)] + [(f"n{i}", f"n{(i * 7 + 1) % 40}") for i in range(40)]
    edges += [(f"n{i}", "hub") for i in range(0, 40, 3)] + [("a", "n5"), ("n5", "n5"), ("alone", "alone")]
    frame = spark.createDataFrame(edges, "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("n3",), ("alone",)], "root string")
    after = {}
    for s, d in edges:
        after.setdefault(s, set()).add(d)
    expected = set()
    for root in ("a", "n3", "alone"):
        best = {root: (root,)}
        newest = [root]
        while newest:
            found = {}
            for node in newest:
                for d in after.get(node, ()):
                    if d not in best:
                        path = (*best[node], d)
                        found[d] = min(found.get(d, path), path)
            best |= found
            newest = list(found)
        expected |= {(root, n, len(p) - 1, p) for n, p in best.items()}
    got = g.walk(frame, seeds, with_path=True)
    assert {(r.root, r.node, r.distance, tuple(r.path)) for r in got.collect()} == expected
    near = {(r.node, r.distance) for r in g.downstream(frame, "a").collect()}
    assert near == {(n, d) for root, n, d, _ in expected if root == "a" and n != "a"}


def test_pairs_and_paths_against_breadth_first_search(spark, monkeypatch):
    """More than 64 sinks, cycles, a hub, sources that lead nowhere, rounds that are merged."""
    monkeypatch.setattr(g, "MERGED", 2)
    edges = [(f"s{i}", f"n{i * 3 % 50}") for i in range(20)] + [("s1", "hub"), ("s2", "s2"), ("lost", "gone")]
    edges += [(f"n{i}", f"n{(i * 7 + 1) % 50}") for i in range(50)] + [(f"n{i}", f"n{i + 1}") for i in range(49)]
    edges += [("hub", f"k{i}") for i in range(90)] + [(f"n{i}", f"k{i % 7}") for i in range(0, 50, 5)]
    sources, sinks = {f"s{i}" for i in range(20)} | {"lost"}, {f"k{i}" for i in range(95)}
    names = {x for e in edges for x in e} | sinks
    kinds = [(n, "source" if n in sources else "sink" if n in sinks else "intermediate") for n in names]
    nodes = g.degrees(spark.createDataFrame(edges, "src string, dst string")).join(
        spark.createDataFrame(kinds, "name string, node_type string"), "name", "right"
    ).na.fill(0).withColumn("label", F.col("name"))
    frame = spark.createDataFrame(edges, "src string, dst string")
    after = {}
    for s, d in edges:
        after.setdefault(s, set()).add(d)
    want = {}
    for root in sources:
        best, newest = {root: (root,)}, [root]
        while newest:
            found = {}
            for node in newest:
                for d in after.get(node, set()) - set(best):
                    found[d] = min(found.get(d, (*best[node], d)), (*best[node], d))
            best |= found
            newest = list(found)
        want |= {(root, n): p for n, p in best.items() if n in sinks}
    got = {(r.source, r.sink): tuple(r.path) for r in g.flow_paths(nodes, frame).collect()}
    assert got == want and len(want) > 200
    assert pairs(g.reachable_pairs(nodes, frame)) == sorted((*k, len(p) - 1) for k, p in want.items())
    row = g.graph_statistics(nodes, frame).first()
    assert (row.flow_paths, row.max_shortest_path) == (len(want), max(len(p) - 1 for p in want.values()))


def test_role_priority(spark):
    log = ProvenanceLog("r")
    log.add_source("t", "csv", "x")
    log.add_sink("t", "csv", "y")
    log.add_transformation("Copy", ["t"], "u")
    log.records["dependencies"].append(("r", "t", "unknown", "r_1"))
    nodes, edges = g.build_graph(log.tables(spark))
    types = {r.name: r.node_type for r in nodes.collect()}
    assert types == {"t": "sink", "u": "intermediate", "transform_r_1": "transformation"}
    assert edges.filter("dst = 'unknown'").count() == 0


def test_empty_provenance(spark):
    nodes, edges = g.build_graph(ProvenanceLog("r").tables(spark))
    row = g.graph_statistics(nodes, edges).first()
    assert (row.total_nodes, row.flow_paths, row.max_shortest_path) == (0, 0, 0)
    assert row.most_connected_node is None


def test_export_and_consolidate(spark, tmp_path, provenance):
    one, two = visits_log(), ProvenanceLog("other")
    two.add_source("visits_file", "csv", "in/visits.csv")
    two.add_transformation("Copy", ["visits_file"], "copy")
    one.export(spark, str(tmp_path / "one"))
    two.export(spark, str(tmp_path / "two"))
    back = read_provenance(spark, [str(tmp_path / "one")])
    for name, table in one.tables(spark).items():
        shown = [c for c, t in table.dtypes if not t.startswith("map") and c != "ts"]
        assert pairs(back[name].select(*shown)) == pairs(table.select(*shown))
    merged = read_provenance(
        spark, [str(tmp_path / n) for n in ("one", "two", "missing", "one")]
    )
    unique = consolidate([merged])
    assert dict(pairs(overview(unique))) == {
        "data_sources": 2, "data_sinks": 1, "transformations": 5, "dependencies": 6,
    }
    listing = transformation_listing(unique).filter("name = 'KeepPaid'").first()
    assert (listing.inputs, listing.input_rows, listing.output_rows) == ("visits_file", 9, 7)
    assert g.build_graph(unique)[0].count() == 12


def test_paths_of_many_sinks_go_together(spark, monkeypatch):
    """What is written on the way grows with the groups, not with pairs times positions."""
    written = []

    def counted(write, folder):
        def run(df, *rest):
            found = write(df, *rest)
            if folder in rest:
                written.append(found.count())
            return found

        return run

    monkeypatch.setattr(g, "store", counted(g.store, "graph-paths"))
    monkeypatch.setattr(g, "_rounds", counted(g._rounds, "graph-paths"))
    edges = [(f"s{i}", "n0") for i in range(5)] + [(f"n{i}", f"n{i + 1}") for i in range(6)]
    edges += [("n6", f"k{i:02}") for i in range(60)]
    names = {x for e in edges for x in e}
    role = {"s": "source", "n": "intermediate", "k": "sink"}
    nodes = spark.createDataFrame([(n, role[n[0]]) for n in names], "name string, node_type string")
    frame = spark.createDataFrame(edges, "src string, dst string")
    paths = g.flow_paths(nodes, frame, with_types=True).localCheckpoint()
    between = [f"n{i}" for i in range(7)]
    assert pairs(paths.select("source", "sink", "path")) == sorted(
        (f"s{i}", f"k{j:02}", [f"s{i}", *between, f"k{j:02}"]) for i in range(5) for j in range(60)
    )
    assert sum(written) <= 5 * 60  # 5 * 60 * 9 when every pair walks by itself
    plain = g.path_positions(paths.drop("node_types"), nodes)
    assert pairs(g.path_positions(paths, nodes)) == pairs(plain)


def test_steps_beside_stated_dependencies_are_no_way(spark):
    """A node leaves the walk only if all that leads to it also leads on without it."""
    edges = [("s", "x"), ("x", "k"), ("s", "k"), ("s", "y"), ("t", "y"), ("y", "j"), ("s", "j"), ("y", "y")]
    nodes = spark.createDataFrame(
        [("s", "source"), ("t", "source"), ("x", "transformation"), ("y", "intermediate"), ("k", "sink"), ("j", "sink")],
        "name string, node_type string",
    )
    frame = spark.createDataFrame(edges, "src string, dst string")
    left = pairs(g._without_detours(nodes, frame))
    assert left == sorted(e for e in edges if "x" not in e)
    assert pairs(g.flow_paths(nodes, frame)) == [
        ("s", "j", ["s", "j"], 1), ("s", "k", ["s", "k"], 1), ("t", "j", ["t", "y", "j"], 2),
    ]


def test_records_of_one_file_are_dealt_before_they_are_sorted(spark, provenance):
    """Names and edges are sorted in many tasks, also where one task reads all records."""
    one = {name: table.coalesce(1) for name, table in provenance.items()}
    for made in (g.typed_names(one), g.build_edges(one, include_dependency_edges=False)):
        lines = made._jdf.queryExecution().executedPlan().toString().splitlines()
        deepest = max(i for i, line in enumerate(lines) if "Aggregate(" in line)
        assert any("REPARTITION_BY_NUM" in line for line in lines[deepest:])
    every = g.build_edges(one)
    assert "Broadcast" not in every._jdf.queryExecution().executedPlan().toString()
    assert pairs(every) == pairs(g.build_graph(provenance)[1])


def test_ends_of_parts_are_counted_not_joined(spark, tmp_path):
    """Sources and sinks once each, a null name equal to none; no task collects the names of a whole file."""
    keys = [*range(12), 3, 5, None]
    parts = spark.createDataFrame([(k, "kind") for k in keys], "p_partkey bigint, p_type string")
    parts.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    found = provenance_of_parts(spark, str(tmp_path))
    read = {f"t_{(k + 8) // n}" for k in range(12) for n in (2, 3)}
    made = {f"t_{k + 8}" for k in range(12)}
    for name, want in (("data_sources", read - made), ("data_sinks", made - read)):
        names = found[name].select("name")
        assert sorted(r.name or "" for r in names.collect()) == sorted({*want, ""})
        plan = names._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        assert "Join" not in plan
        deepest = max(i for i, line in enumerate(lines) if "Aggregate(" in line)
        assert any("REPARTITION_BY_NUM" in line for line in lines[deepest:])


def test_a_task_that_reads_one_file_deals_its_records_unsorted(spark, tmp_path):
    """Above 200 partitions a shuffle's writer holds and sorts all rows of its task."""
    parts = spark.createDataFrame([(k, f"kind {k % 3}") for k in range(40)], "p_partkey bigint, p_type string")
    parts.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))

    def made():
        found = provenance_of_parts(spark, str(tmp_path))
        return [found["data_sources"], found["data_sinks"], g.typed_names(found), g.build_edges(found)]

    few = [pairs(df) for df in made()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "201")
    try:
        many = made()
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in many]
        got = [pairs(df) for df in many]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for plan in plans:
        dealt = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
        assert dealt and all(", 200), REPARTITION_BY_NUM" in line for line in dealt)
    assert got == few


def test_stated_dependencies_are_dealt_before_they_meet_the_names(spark, provenance):
    """The joins read dealt rows, not those of the task that reads all; names may come twice."""
    names = g.typed_names(provenance).select("name").localCheckpoint()
    one = provenance | {"dependencies": provenance["dependencies"].coalesce(1)}
    edges = g.build_edges(one, names=names.union(names).filter("name != 'visits'"))
    lines = edges._jdf.queryExecution().optimizedPlan().toString().splitlines()
    deepest = max(i for i, line in enumerate(lines) if "Join " in line)
    assert any("RepartitionByExpression" in line for line in lines[deepest:])
    stated = edges.filter("edge_type = 'dependency'").select("src", "dst")
    assert pairs(stated) == [
        ("people", "visits_of_people"), ("people_file", "people"), ("visits_of_people", "visit_counts"),
    ]


def test_rounds_join_only_the_edges(spark, graph, monkeypatch):
    """Bits that are known meet the new ones in an aggregate; a round has one join."""
    plans, rounds = [], g._rounds

    def watched(first, step, label):
        def seen_step(*args):
            found = step(*args)
            if label == "graph-distances":
                plans.append(found._jdf.queryExecution().optimizedPlan().toString())
            return found

        return rounds(first, seen_step, label)

    monkeypatch.setattr(g, "_rounds", watched)
    nodes, edges = graph
    assert pairs(g.reachable_pairs(nodes, edges)) == [
        ("people_file", "visit_counts", 3), ("visits_file", "visit_counts", 3),
    ]
    assert plans and all(plan.count("Join ") == 1 for plan in plans)
