import pytest
from pyspark.sql import functions as F

from tableloom.functions import storage
from tableloom.plans import steps as st
from tableloom.plans.runs import check_against_spec, run_steps, steps_from_spec
from tableloom.plans.registry import OPERATORS, Operator, find, register
from tableloom.plans.reports import DEMO_STEPS
from tableloom.sources import synthetic as s
from tableloom.sources import writers as w
from tableloom.sources.readers import Workspace, read_stage, read_table

STEPS = [
    {"inputs": ["orders"], "operator": "remove_nulls", "parameters": {"columns": ["v"]}},
    {
        "inputs": ["orders_remove_nulls_1", "people"], "operator": "join",
        "parameters": {"join_keys": ["k"]}, "output": "joined",
    },
    {
        "inputs": ["joined"], "operator": "group_by", "output": "totals",
        "parameters": {"group_by_columns": ["name"], "aggregations": {"v": "sum"}},
    },
]


@pytest.fixture
def workspace(spark):
    space = Workspace(spark)
    space.add("orders", spark.createDataFrame([(1, 5), (1, 7), (2, None), (3, 9)], "k int, v int"))
    space.add("people", spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string"))
    return space


def test_measured_run(workspace):
    run = run_steps(workspace, STEPS, measure=True)
    assert [tuple(r) for r in run.result.collect()] == [("a", 12)]
    steps = run.steps()
    assert [tuple(r) for r in st.results_summary(steps).collect()] == [
        (1, "Remove nulls", "orders", "orders_remove_nulls_1", 3, 2),
        (2, "Join", "orders_remove_nulls_1, people", "joined", 2, 3),
        (3, "Group by", "joined", "totals", 1, 2),
    ]
    assert [r.change_percentage for r in st.record_impact(steps).collect()] == [-25.0, -33.3, -50.0]
    total = st.throughput(steps).first()
    assert (total.total_input_rows, total.total_output_rows, total.efficiency) == (9, 6, 66.7)
    changes = st.step_change(steps).orderBy("step").collect()
    assert [r.data_change for r in changes] == [None, "-1 (-33.3%)", "-1 (-50.0%)"]
    about = st.run_statistics(steps).first()
    assert (about.steps, about.start_dataset, about.final_dataset) == (3, "orders", "totals")
    assert st.volume_series(steps).count() == 6
    assert st.step_timing(steps).filter("elapsed_ms >= 0").count() == 3
    assert st.flow_links(steps).count() == 4 and st.flow_links_via_steps(steps).count() == 7
    nodes, edges = st.step_graph(steps)
    assert dict(tuple(r) for r in nodes.collect())["people"] == "source" and edges.count() == 4
    evolution = {(r.step, r.column): r.change for r in run.schema_evolution().collect()}
    assert evolution[(2, "name")] == "added" and evolution[(3, "k")] == "removed"
    assert workspace.log.tables(workspace.spark)["dependencies"].count() == 4


def test_lazy_run_counts_nothing(workspace):
    run = run_steps(workspace, STEPS)
    assert run.steps().filter("output_rows IS NOT NULL").count() == 0
    assert run.result.count() == 1


def test_run_stops_at_failure(workspace):
    broken = [STEPS[0], {"inputs": ["orders"], "operator": "nonsense"}, STEPS[1]]
    run = run_steps(workspace, broken)
    assert [r.success for r in run.steps().orderBy("step").collect()] == [None, False]
    measured = run_steps(workspace, broken, measure=True)
    assert [r.success for r in measured.steps().orderBy("step").collect()] == [True, False]
    with pytest.raises(RuntimeError, match="nonsense"):
        run.result
    for bad in (
        {"inputs": ["orders"], "operator": "join", "parameters": {"join_keys": ["k"]}},
        {"inputs": ["nobody"], "operator": "remove_nulls"},
        {"inputs": ["orders"], "operator": "union"},
    ):
        assert not run_steps(workspace, [bad]).records[0][10]


def test_spec_round_trip(workspace, spark, tmp_path):
    run = run_steps(workspace, STEPS, measure=True)
    catalogue = {"orders": {"path": "orders.csv", "format": "csv"}}
    w.export_spec(spark, run.steps(), catalogue, str(tmp_path / "spec"))
    spec = spark.read.json(str(tmp_path / "spec"))
    again = run_steps(workspace, steps_from_spec(spec), measure=True)
    assert again.result.collect() == run.result.collect()
    assert check_against_spec(again, spec).count() == 0
    workspace.add("orders", workspace.tables["orders"].limit(0))
    assert check_against_spec(run_steps(workspace, steps_from_spec(spec), True), spec).count() == 3


def test_exports(workspace, spark, tmp_path):
    run = run_steps(workspace, STEPS, measure=True)
    folder = str(tmp_path)
    written = w.export_tables(workspace.tables, folder)
    written += w.export_steps(run.steps(), folder)
    written += w.export_quality({"orders": workspace.tables["orders"]}, folder)
    manifest = w.export_manifest(spark, written, folder)
    assert manifest.filter("kind = 'dataset'").count() == 5
    assert spark.read.parquet(f"{folder}/datasets/joined").count() == 2
    assert spark.read.option("header", True).csv(f"{folder}/datasets/joined_sample").count() == 2
    assert spark.read.json(f"{folder}/execution_results").count() == 3
    assert spark.read.json(f"{folder}/quality_reports/orders").first().total_rows == 4
    assert spark.read.json(f"{folder}/manifest").count() == manifest.count()


def test_graph_export(workspace, spark, tmp_path):
    nodes, edges = st.step_graph(run_steps(workspace, STEPS).steps())
    written = w.export_graph(nodes, edges, str(tmp_path))
    assert [(kind, name, rows) for _, kind, name, rows, _ in written] == [
        ("graph", "nodes", nodes.count()), ("graph", "links", edges.count()),
    ]
    back = read_table(spark, str(tmp_path / "graph" / "links"), "json")
    assert back.filter("src = 'joined' AND dst = 'totals'").count() == 1


def test_registry(spark):
    assert {len(OPERATORS["Data Cleaning"]), len(OPERATORS["Joins & Integration"])} == {9, 5}
    assert find("cross_join").inputs == 2
    with pytest.raises(ValueError):
        find("join", "Aggregations")
    register("Own", "double", Operator(lambda df, column: df.withColumn(column, F.col(column) * 2), "Double"))
    assert find("join").parameters["join_type"] == {"type": "str", "required": False, "default": "inner"}
    assert find("join").parameters["join_keys"]["required"] and find("union").inputs == "many"
    space = Workspace(spark)
    space.add("t", spark.range(3))
    run = run_steps(space, [{"inputs": ["t"], "operator": "double", "parameters": {"column": "id"}}])
    assert sorted(r.id for r in run.result.collect()) == [0, 2, 4]
    del OPERATORS["Own"]


def test_files(workspace, spark, tmp_path):
    text = spark.createDataFrame([(1, ' a "q", b\nc '), (2, "é\\"), (3, None)], "k int, t string")
    for kind in ("csv", "json", "parquet"):
        path = str(tmp_path / kind)
        w.write_table(text, path, kind)
        back = read_table(spark, path, kind, schema=text.schema)
        assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in text.collect()), kind
        w.write_table(text, path, kind, "append")
        assert read_table(spark, path, kind).count() == 6
        w.write_table(text, path, kind, "ignore")
        with pytest.raises(Exception):
            w.write_table(text, path, kind, "error")
    for call in (
        lambda: read_table(spark, "x", "xml"),
        lambda: w.write_table(text, "x", "xml"),
        lambda: w.write_table(text, "x", "csv", "upsert"),
    ):
        with pytest.raises(ValueError):
            call()


def test_workspace(spark, tmp_path):
    space = Workspace(spark)
    space.add("t", spark.createDataFrame([(1, 2.5, "x")], "a int, b double, c string"))
    space.save("t", str(tmp_path / "t.csv"), "csv")
    space.save("t", str(tmp_path / "stage" / "t"))
    loaded = space.load_all(
        {
            "typed": {"path": "/t.csv", "format": "csv", "options": {"header": "true", "inferSchema": "true"}},
            "text": {"path": "/t.csv", "options": {"header": "true", "inferSchema": "false"}},
            "gone": {"path": "/nowhere.csv"},
            "odd": {"path": "/t.csv", "format": "xml"},
        },
        str(tmp_path),
    )
    assert dict(loaded["typed"].dtypes) == {"a": "int", "b": "double", "c": "string"}
    assert set(dict(loaded["text"].dtypes).values()) == {"string"}
    assert space.skipped["gone"] == "missing" and "xml" in space.skipped["odd"]
    assert spark.table("typed").count() == space.rows("typed") == 1
    assert read_stage(spark, str(tmp_path / "stage"), "t").count() == 1
    lists = space.log.tables(spark)
    assert lists["data_sources"].first().schema == {"a": "int", "b": "double", "c": "string"}
    assert lists["data_sinks"].count() == 2
    with pytest.raises(Exception):
        space.load("gone", str(tmp_path / "nowhere.parquet"), "parquet")


def test_degraded_scan(spark, tmp_path, monkeypatch):
    from pyspark.errors import AnalysisException

    import tableloom.sources.readers as readers

    w.write_table(spark.range(2), str(tmp_path / "t"), "csv")

    def fails(*_, **__):
        raise AnalysisException("no types")

    monkeypatch.setattr(readers, "read_table", fails)
    space = Workspace(spark)
    assert space.load("t", str(tmp_path / "t")).dtypes == [("id", "string")]
    assert space.degraded == {"t"}


class Session:
    """What shared_folder asks of a session."""

    def __init__(self, setting=None, master="local[2]"):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext, self.master, self.folder = self, master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    stored = storage.store(spark.range(5), "five")
    assert stored.count() == 5
    assert all(f"{named}/five-" in f for f in stored.inputFiles())
    assert storage.shared_folder(Session("hdfs://x/y/", "yarn")) == "hdfs://x/y"
    local = Session()
    assert storage.shared_folder(local) == storage.shared_folder(local) == local.folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session(master="yarn"))


def test_synthetic_tables(spark):
    people = s.customers(s.row_numbers(spark, 400))
    goods = s.products(s.row_numbers(spark, 50))
    sales = s.orders(s.row_numbers(spark, 600), 400)
    items = s.order_items(s.row_numbers(spark, 600), goods, 50)
    moves = s.inventory(s.row_numbers(spark, 50), goods)
    assert people.select("customer_id").distinct().count() == 400
    assert people.filter("age NOT BETWEEN 18 AND 80").count() == 0
    assert goods.filter("cost < 0.599 * price OR cost > 0.801 * price").count() == 0
    assert sales.join(people, "customer_id", "left_anti").count() == 0
    assert sales.filter("datediff(shipping_date, order_date) NOT BETWEEN 1 AND 7").count() == 0
    assert sales.filter("datediff(delivery_date, shipping_date) NOT BETWEEN 1 AND 14").count() == 0
    shares = {r.order_status: r["count"] / 600 for r in sales.groupBy("order_status").count().collect()}
    assert abs(shares["Delivered"] - 0.6) < 0.05
    per_order = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("product_id").alias("d")
    )
    assert per_order.filter("n <> d OR n > 5").count() == 0 and per_order.count() == 600
    totals = s.with_totals(sales, items)
    assert totals.columns == sales.columns and totals.filter("total_amount <= 0").count() == 0
    per_product = moves.groupBy("product_id").count()
    assert per_product.filter("count NOT BETWEEN 5 AND 20").count() == 0
    assert moves.select("inventory_id").distinct().count() == moves.count()
    dated = moves.filter("expiry_date IS NOT NULL").count() / moves.count()
    assert 0.2 < dated < 0.4


def test_demo_steps(spark):
    space = Workspace(spark)
    space.add("customers", s.customers(s.row_numbers(spark, 200)))
    run = run_steps(space, DEMO_STEPS, measure=True)
    assert run.result.columns == ["customer_tier", "state", "age_avg", "customer_id_count"]
    assert run.result.agg(F.sum("customer_id_count")).first()[0] == 200
