"""Tables by version, runs that go on, loads that know their files, rejected records, stored counts."""

from __future__ import annotations

import json
import os
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_sinks_and_pipeline import sources  # noqa: F401

from salesmarts import PipelineConfig, run_pipeline
from salesmarts.operators.audit import stored_row_counts
from salesmarts.plans import pipeline
from salesmarts.session import scratch_path
from salesmarts.sinks import tables
from salesmarts.sinks.tables import described, drop_schema, ensure_schema, load_table, publish_json_view, replace_table, table_location
from salesmarts.sources import loads
from salesmarts.sources.files import read_csv, read_raw_json
from salesmarts.sources.loads import TooManyRejects, ledger_of, load_checked, load_new_files
from salesmarts.sources.schemas import JSON_FIELDS


@pytest.fixture()
def schema(spark, tmp_path):
    name = f"stored_{tmp_path.name.replace('-', '_')}"
    ensure_schema(spark, name, str(tmp_path / "schema"))
    yield name
    drop_schema(spark, name)


def failing(spark, n=100):
    """Rows whose last one cannot be written."""
    at = F.col("id")
    return spark.range(0, n, 1, 4).select(F.when(at == n - 1, F.raise_error(F.lit("broken"))).otherwise(at).cast("bigint").alias("id"))


# One version takes another's place


def test_a_write_that_fails_half_way_leaves_the_old_rows(spark, schema):
    table = f"{schema}.t"
    replace_table(spark.range(5), table)
    place = table_location(spark, table)
    with pytest.raises(Exception, match="broken"):
        replace_table(failing(spark), table)
    assert spark.table(table).count() == 5 and table_location(spark, table) == place
    with pytest.raises(Exception, match="broken"):
        replace_table(failing(spark), f"{schema}.never")
    assert not spark.catalog.tableExists(f"{schema}.never")
    folder = os.path.dirname(place.removeprefix("file:"))
    assert len(os.listdir(folder)) == 1 and os.listdir(os.path.join(os.path.dirname(folder), "never")) == []


def test_a_failure_while_the_name_is_moved_leaves_the_old_rows(spark, schema, monkeypatch):
    table = f"{schema}.t"
    replace_table(spark.range(5), table)

    def fail(*_):
        raise RuntimeError("lost the catalogue")

    with monkeypatch.context() as m:
        m.setattr(tables, "_show", fail)
        with pytest.raises(RuntimeError):
            replace_table(spark.range(9), table)
    assert spark.table(table).count() == 5
    assert replace_table(spark.range(9), table) == 9 and spark.table(table).count() == 9


def test_the_old_version_is_deleted_and_a_table_can_be_made_from_itself(spark, schema):
    table = f"{schema}.t"
    replace_table(spark.range(5), table)
    old = table_location(spark, table).removeprefix("file:")
    replace_table(spark.table(table).where("id > 1"), table)
    assert rows(spark.table(table)) == [(2,), (3,), (4,)] and not os.path.exists(old)


def test_other_columns_and_partitions(spark, schema):
    table = f"{schema}.t"
    replace_table(spark.range(5), table)
    replace_table(spark.range(6).withColumn("p", F.col("id") % 2), table, partition_by=("p",))
    assert spark.table(table).where("p = 1").count() == 3 and spark.sql(f"SHOW PARTITIONS {table}").count() == 2
    replace_table(spark.range(9).withColumn("p", F.col("id") % 3), table, partition_by=("p",))
    assert spark.table(table).count() == 9 and spark.sql(f"SHOW PARTITIONS {table}").count() == 3
    replace_table(spark.range(2).select(F.col("id").cast("string").alias("name")), table)
    assert rows(spark.table(table)) == [("0",), ("1",)] and not spark.catalog.tableExists(f"{table}__next")


def test_a_managed_table_and_a_view_are_replaced(spark, schema):
    spark.range(4).write.saveAsTable(f"{schema}.managed")
    replace_table(spark.range(7), f"{schema}.managed")
    assert spark.table(f"{schema}.managed").count() == 7
    spark.sql(f"CREATE VIEW {schema}.v AS SELECT 1 AS x")
    replace_table(spark.range(3), f"{schema}.v")
    assert spark.table(f"{schema}.v").count() == 3


def test_appending_makes_no_record_of_what_a_table_was_made_from(spark, schema):
    table = f"{schema}.t"
    replace_table(spark.range(3), table, inputs="one")
    assert tables.rows_if_made_from(spark, described(spark, table), "one") == 3
    assert tables.rows_if_made_from(spark, described(spark, table), "two") is None
    load_table(spark.range(2), table, mode="append")
    assert tables.rows_if_made_from(spark, described(spark, table), "one") is None and spark.table(table).count() == 5


# Counts from footers


def test_stored_counts_read_no_row_group(spark, schema):
    made = {"a": spark.range(7), "b": spark.range(0), "c": spark.range(30).withColumn("p", F.col("id") % 3)}
    for name, df in made.items():
        replace_table(df, f"{schema}.{name}", partition_by=("p",) if name == "c" else ())
    counts = stored_row_counts(spark, {name: table_location(spark, f"{schema}.{name}") for name in made})
    assert rows(counts) == [("a", 7), ("b", 0), ("c", 30)]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") >= 3 and "FileScan" not in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


# Variants behind a view of the catalogue


def test_variants_are_kept_and_read_through_a_permanent_view(spark, schema, tmp_path):
    records = [{"ProductID": 1, "ProductName": "Chai", "UnitPrice": 18.5, "more": [1]}, {"ProductID": 2, "CategoryID": 4}]
    for name, text in (("array", json.dumps(records)), ("lines", "\n".join(map(json.dumps, records)) + "\n\n")):
        (tmp_path / name).write_text(text)
        raw = read_raw_json(spark, str(tmp_path / name), whole_files=name == "array")
        load_table(raw, f"{schema}.raw", source_system="object_store")
        publish_json_view(spark, f"{schema}.products", f"{schema}.raw", "raw_json", JSON_FIELDS["products"], ["_source_system"])
        assert rows(spark.newSession().table(f"{schema}.products")) == rows(spark.createDataFrame(
            [(1, "Chai", None, None, 18.5, "object_store"), (2, None, 4, None, None, "object_store")],
            "a bigint, b string, c bigint, d bigint, e double, f string",
        ))
    assert isinstance(spark.table(f"{schema}.raw").schema["raw_json"].dataType, T.VariantType)
    assert spark.table(f"{schema}.raw").where("variant_get(raw_json, '$.more[0]', 'int') = 1").count() == 1


# Files loaded once


@pytest.fixture()
def landing(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def land(name, *ids):
        (folder / name).write_text("ID,Name\n" + "".join(f"{i},n{i}\n" for i in ids))

    def load(table):
        read = lambda files: read_csv(spark, files, "ID BIGINT, Name STRING")
        return load_new_files(spark, f"{folder}/*.csv", table, read, "store", {"ID": "id"})

    return land, load


def test_files_are_loaded_once(spark, schema, landing):
    land, load = landing
    table = f"{schema}.t"
    land("a.csv", 1, 2)
    land("b.csv", 3)
    assert [load(table), load(table)] == [3, 0]
    land("c.csv", 4, 5)
    assert [load(table), load(table)] == [2, 0]
    got = spark.table(table)
    assert sorted(r.id for r in got.collect()) == [1, 2, 3, 4, 5]
    assert got.select("_load_id").distinct().count() == 2
    assert {os.path.basename(r[0]) for r in got.select("_source_file").distinct().collect()} == {"a.csv", "b.csv", "c.csv"}
    assert spark.table(ledger_of(table)).count() == 3
    land("a.csv", 1, 2, 6)  # changed: another file
    assert load(table) == 3 and spark.table(table).count() == 8


@pytest.mark.parametrize("first", [True, False])
def test_a_load_that_fails_is_made_up_for_once(spark, schema, landing, monkeypatch, first):
    land, load = landing
    table = f"{schema}.t"
    if not first:
        land("a.csv", 1)
        load(table)
    land("b.csv", 2, 3)
    before = load_table

    def fail(*args, **kw):
        before(*args, **kw)
        raise RuntimeError("lost after the ledger was written")

    with monkeypatch.context() as m:
        m.setattr(loads, "load_table", fail)
        with pytest.raises(RuntimeError):
            load(table)
    assert first or spark.table(table).count() == 1
    assert load(table) == 2 and load(table) == 0
    assert sorted(r.id for r in spark.table(table).collect()) == ([2, 3] if first else [1, 2, 3])


# Records that do not parse


def test_rejects_are_set_apart_up_to_a_limit(spark, schema, tmp_path):
    table, rejects = f"{schema}.t", f"{schema}.rejects"
    good = tmp_path / "good"
    good.mkdir()
    (good / "x.csv").write_text("id,name\n1,one\n2,two\n")
    assert load_checked(spark, str(good), table, "id BIGINT, name STRING", rejects) == (2, 0)
    assert not spark.catalog.tableExists(rejects)
    (good / "y.csv").write_text("id,name\n3,three\nfour,4\n5,five,5\n6,\n")
    with pytest.raises(TooManyRejects):
        load_checked(spark, str(good), table, "id BIGINT, name STRING", rejects, limit=1)
    assert spark.table(table).count() == 2 and spark.table(rejects).count() == 2
    assert load_checked(spark, str(good), table, "id BIGINT, name STRING", rejects, limit=2) == (4, 2)
    assert sorted(r.id for r in spark.table(table).collect()) == [1, 2, 3, 6]
    found = spark.table(rejects).collect()
    assert {(os.path.basename(r._source_file), r.record, r.table_name) for r in found} == {("y.csv", "four,4", table), ("y.csv", "5,five,5", table)}
    assert len(found) == 4 and all(r._file_start == 0 and r.rejected_at for r in found)


def test_rejected_json_records(spark, schema, tmp_path):
    (tmp_path / "x.json").write_text('{"id": 1}\n{"id": "x"}\n{"id"\n')
    assert load_checked(spark, str(tmp_path / "x.json"), f"{schema}.t", "id BIGINT", f"{schema}.r", fmt="json", limit=5) == (1, 2)
    assert sorted(r.record for r in spark.table(f"{schema}.r").collect()) == ['{"id"', '{"id": "x"}']


# Runs that go on


@pytest.fixture()
def named_run(spark, sources, tmp_path):  # noqa: F811
    tag = tmp_path.name.replace("-", "_")
    cfg = PipelineConfig(
        object_store_path=sources[0], bronze_schema=f"b_{tag}", silver_schema=f"s_{tag}", gold_schema=f"g_{tag}",
        location=str(tmp_path / "tables"), run_id="one", fact_partition_by=("region",),
    )
    yield cfg, sources[1]
    for layer in ("bronze", "silver", "gold"):
        drop_schema(spark, cfg.schema(layer))


def written_by(monkeypatch, run):
    """Names of the tables that ``run`` writes."""
    names, write = [], pipeline.replace_table

    def noting(df, table, *args, **kw):
        names.append(table.split(".")[1])
        return write(df, table, *args, **kw)

    with monkeypatch.context() as m:
        m.setattr(pipeline, "replace_table", noting)
        try:
            run()
        except RuntimeError as e:
            names.append(str(e))
    return names


def test_a_run_that_failed_goes_on_where_it_stopped(spark, named_run, monkeypatch):
    cfg, database = named_run

    def stopped():
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(pipeline, "build_gold", lambda store: stopped())
        first = written_by(monkeypatch, lambda: run_pipeline(spark, cfg, database))
    assert len(first) == 17 and first[-1] == "stopped" and "bronze_products_raw" in first
    second = written_by(monkeypatch, lambda: run_pipeline(spark, cfg, database))
    assert len(second) == 7 and all(n.startswith("gold_") for n in second)
    lost = {}
    assert written_by(monkeypatch, lambda: run_pipeline(spark, cfg, database, rejected=lost)) == []
    counts = run_pipeline(spark, cfg, database)
    assert len(counts) == 23 and all(spark.table(t).count() == n for t, n in counts.items())


def test_a_run_writes_again_what_changed_and_what_follows_from_it(spark, named_run, monkeypatch):
    from dataclasses import replace

    cfg, database = named_run
    run_pipeline(spark, cfg, database)
    again = lambda c: written_by(monkeypatch, lambda: run_pipeline(spark, c, database))
    assert again(replace(cfg, churn_days=90)) == ["gold_customer_churn", "gold_churn_summary"]
    assert again(replace(cfg, churn_days=90, top_n=3)) == ["gold_top_products"]
    replace_table(spark.table(cfg.table("silver", "customers")), cfg.table("silver", "customers"))
    after = again(replace(cfg, churn_days=90, top_n=3))
    assert after[:2] == ["silver_customers", "gold_sales_fact"] and "bronze_customers" not in after
    assert len(again(replace(cfg, run_id="two"))) == 23


def test_a_changed_file_is_landed_again(spark, named_run, monkeypatch, tmp_path):
    import shutil
    from dataclasses import replace

    cfg, database = named_run
    store = tmp_path / "store"
    shutil.copytree(cfg.object_store_path, store)
    cfg = replace(cfg, object_store_path=str(store))
    run_pipeline(spark, cfg, database)
    with open(store / "products.json") as f:
        products = json.load(f)
    (store / "products.json").write_text(json.dumps(products[:-1]))
    again = written_by(monkeypatch, lambda: run_pipeline(spark, cfg, database))
    assert again[:2] == ["bronze_products_raw", "silver_products"] and not any(n.startswith("silver_orders") for n in again)
    assert spark.table(cfg.table("bronze", "products")).count() == len(products) - 1


def test_lost_values_are_kept_with_the_tables(spark, named_run):
    cfg, database = named_run
    bad = spark.createDataFrame(
        [(1, 1, "9999999999999999", "9000000000000000000", "-9999999999999999"), (2, 1, "abc", "2", "0")],
        "OrderID bigint, ProductID bigint, UnitPrice string, Quantity string, Discount string",
    )
    first, second = {}, {}
    run_pipeline(spark, cfg, database | {"orderdetails": bad}, rejected=first)
    run_pipeline(spark, cfg, database | {"orderdetails": bad}, rejected=second)
    assert first == second == {"order_details.price_cents": 1, "order_details.line_revenue": 1}


def test_counts_of_the_stored_layers(spark, named_run):
    cfg, database = named_run
    counts = run_pipeline(spark, cfg, database)
    stored = pipeline.stored_tables(spark, cfg)
    assert len(stored) == 23
    by_name = {t.split(".")[1].removesuffix("_raw"): n for t, n in counts.items()}
    assert {r.table_name: r.row_count for r in stored_row_counts(spark, stored).collect()} == by_name


class Cluster:
    """A session on a cluster, as far as the choice of a scratch folder asks."""

    def __init__(self, spark, told):
        context = spark.sparkContext
        self.conf = SimpleNamespace(get=lambda key, default=None: told.get(key, default) if key in told else default)
        self.sparkContext = SimpleNamespace(
            master="spark://host:7077", applicationId="app", getCheckpointDir=lambda: None, _jvm=context._jvm, _jsc=context._jsc
        )


def test_scratch_on_a_cluster_needs_a_shared_folder(spark, tmp_path):
    own = {"spark.sql.warehouse.dir": f"file:{tmp_path}"}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Cluster(spark, own), "x")
    shared = own | {"spark.checkpoint.dir": str(tmp_path / "shared")}
    assert scratch_path(Cluster(spark, shared), "x").startswith(str(tmp_path / "shared"))
