from __future__ import annotations

import gzip
import importlib

import pytest
from conftest import rows

from salesmarts.sinks.tables import publish_view
from salesmarts.sources.database import TableSplit, read_database_table
from salesmarts.sources.files import (
    json_fields,
    json_object_rows,
    read_csv,
    read_json_object,
    read_json_records,
    read_raw_json,
)
from salesmarts.sources.lineage import with_lineage
from salesmarts.sources.schemas import CSV_FILES, JSON_RECORDS

BAD_INPUT = "(?i)malformed|failfast|header"

CATEGORIES = (
    "CategoryID,CategoryName,Description\n"
    '1,Garden,"Spades, rakes, and hoses"\n'
    "4,Kitchen Tools,Whisks\n"
)
PRODUCTS = """[
  {"ProductID": 1, "ProductName": "Spade", "CategoryID": 1, "SupplierID": 1, "UnitPrice": 18.0},
  {"ProductID": 2, "ProductName": "Rake", "CategoryID": 1, "SupplierID": 1, "UnitPrice": 19.0}
]"""
LOOKUP = '{"Germany": "EMEA", "UK": "EMEA", "Mexico": "AMER", "Japan": "APAC"}'


def _put(tmp_path, name, text):
    path = tmp_path / name
    if name.endswith(".gz"):
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text)
    return str(path)


@pytest.mark.parametrize("name", ["categories.csv", "categories.csv.gz"])
def test_csv(spark, tmp_path, name):
    df = read_csv(spark, _put(tmp_path, name, CATEGORIES), CSV_FILES["categories"])
    assert rows(df) == [
        (1, "Garden", "Spades, rakes, and hoses"),
        (4, "Kitchen Tools", "Whisks"),
    ]


def test_csv_infers_types_without_a_schema(spark, tmp_path):
    df = read_csv(spark, _put(tmp_path, "c.csv", CATEGORIES))
    assert dict(df.dtypes)["CategoryID"] == "int"


def test_csv_null_tokens_and_quotes(spark, tmp_path):
    text = 'id,note\n1,\n2,NULL\n3,""\n4,"a, ""b"""\n5,null\n'
    df = read_csv(spark, _put(tmp_path, "n.csv", text), "id INT, note STRING")
    assert [r.note for r in df.orderBy("id").collect()] == [None, None, None, 'a, "b"', "null"]


def test_csv_other_delimiter(spark, tmp_path):
    df = read_csv(spark, _put(tmp_path, "d.csv", "id|note\n1|a,b\n"), "id INT, note STRING", delimiter="|")
    assert rows(df) == [(1, "a,b")]


def test_csv_bad_record_aborts_the_load(spark, tmp_path):
    path = _put(tmp_path, "bad.csv", "id,n\n1,2\nx,3\n")
    with pytest.raises(Exception, match=BAD_INPUT):
        read_csv(spark, path, "id INT, n INT").collect()
    assert rows(read_csv(spark, path, "id INT, n INT", fail_fast=False)) == [(None, 3), (1, 2)]


def test_csv_header_must_match_the_schema(spark, tmp_path):
    path = _put(tmp_path, "h.csv", "n,id\n1,2\n")
    with pytest.raises(Exception, match=BAD_INPUT):
        read_csv(spark, path, "id INT, n INT").collect()


@pytest.mark.parametrize("name", ["products.json", "products.json.gz"])
def test_json_array_of_records(spark, tmp_path, name):
    df = read_json_records(spark, _put(tmp_path, name, PRODUCTS), JSON_RECORDS["products"])
    assert rows(df) == [(1, "Spade", 1, 1, 18.0), (2, "Rake", 1, 1, 19.0)]


def test_json_array_per_line(spark, tmp_path):
    path = _put(tmp_path, "l.json", '[{"a": 1}, {"a": 2}]\n[{"a": 3}]\n')
    assert rows(read_json_records(spark, path, "a INT", multi_line=False)) == [(1,), (2,), (3,)]


def test_bad_json_aborts_the_load(spark, tmp_path):
    path = _put(tmp_path, "bad.json", '[{"ProductID": 1}, {"ProductID": ]')
    with pytest.raises(Exception, match=BAD_INPUT):
        read_json_records(spark, path, JSON_RECORDS["products"]).collect()


@pytest.mark.parametrize("name", ["lookup.json", "lookup.json.gz"])
def test_json_object_to_rows(spark, tmp_path, name):
    df = read_json_object(spark, _put(tmp_path, name, LOOKUP), "Country", "Region")
    assert df.columns == ["Country", "Region"]
    assert rows(df) == [("Germany", "EMEA"), ("Japan", "APAC"), ("Mexico", "AMER"), ("UK", "EMEA")]


def test_bad_json_object_aborts_the_load(spark, tmp_path):
    with pytest.raises(Exception, match=BAD_INPUT):
        read_json_object(spark, _put(tmp_path, "o.json", '{"a": "b"'), "k", "v").collect()


def test_json_object_rows_stay_beside_their_row(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": "x"}'), (2, "{}"), (3, None)], "id int, j string")
    assert rows(json_object_rows(df, "j", keep=["id"])) == [(1, "a", "1"), (1, "b", "x")]


def test_paths_into_raw_json(spark, tmp_path):
    raw = read_raw_json(spark, _put(tmp_path, "p.json", PRODUCTS))
    fields = {
        "product_id": ("$.ProductID", "bigint"),
        "product_name": ("$.ProductName", "string"),
        "unit_price": ("$.UnitPrice", "double"),
        "missing": ("$.Nothing", "string"),
    }
    assert rows(json_fields(raw, "raw_json", fields)) == [
        (1, "Spade", 18.0, None), (2, "Rake", 19.0, None),
    ]


def test_view_over_raw_json(spark, tmp_path):
    raw = with_lineage(read_raw_json(spark, _put(tmp_path, "p.json", PRODUCTS)), "object_store")
    fields = {"product_id": ("$.ProductID", "bigint"), "unit_price": ("$.UnitPrice", "double")}
    publish_view(json_fields(raw, "raw_json", fields, keep=["_source_system"]), "raw_products")
    got = spark.sql("SELECT _source_system, sum(unit_price) FROM raw_products GROUP BY 1")
    assert rows(got) == [("object_store", 37.0)]


def test_lineage(spark):
    row = with_lineage(spark.range(1), "object_store").first()
    assert row._source_system == "object_store" and row._ingest_ts is not None


class _Reader:
    """Stands in for the session's reader and records what it is asked for."""

    def __init__(self):
        self.asked = {}

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.asked = options
        return self

    def load(self):
        return self

    def first(self):
        return (10248, 10405)

    def jdbc(self, url, table, predicates, properties):
        self.asked = {"dbtable": table, "predicates": predicates, **properties}
        return self


def test_database_table_is_read_in_ranges():
    reader = _Reader()
    read_database_table(reader, "jdbc:x", "Orders", TableSplit("OrderID", 8), {"user": "u"})
    assert reader.asked == {
        "url": "jdbc:x", "dbtable": "Orders", "fetchsize": "10000", "user": "u",
        "partitionColumn": "OrderID", "lowerBound": "10248", "upperBound": "10406",
        "numPartitions": "8",
    }
    read_database_table(
        reader, "jdbc:x", "Orders", TableSplit("OrderID", 4, bounds=(1, 9)), schema="OrderID BIGINT"
    )
    assert reader.asked["customSchema"] == "OrderID BIGINT"
    assert (reader.asked["lowerBound"], reader.asked["upperBound"]) == ("1", "10")


def test_database_table_by_predicates_or_whole():
    reader = _Reader()
    conditions = ("CustomerID < 'M'", "CustomerID >= 'M' OR CustomerID IS NULL")
    read_database_table(reader, "jdbc:x", "Customers", TableSplit(predicates=conditions))
    assert reader.asked["predicates"] == list(conditions)
    read_database_table(reader, "jdbc:x", "Shippers")
    assert "numPartitions" not in reader.asked


class _Database(_Reader):
    """Answers the reader's queries from rows of this process."""

    def __init__(self, con):
        super().__init__()
        self.con, self.queries = con, []

    def collect(self):
        self.queries.append(self.asked["query"])
        return self.con.execute(self.asked["query"]).fetchall()


@pytest.mark.parametrize("engine", ["duckdb", "sqlite3"])
def test_ranges_of_equal_rows_however_the_ids_are_spread(engine):
    con = importlib.import_module(engine).connect(":memory:")
    con.execute("CREATE TABLE Lines (OrderID BIGINT, x BIGINT)")
    # Nine tenths of the ids in a thousandth of their range, one id many times, some without one.
    ids = [*range(500_000, 509_000), *range(0, 10_000_000, 10_000), *([700_001] * 700), *([None] * 9)]
    con.executemany("INSERT INTO Lines VALUES (?, ?)", [(i, k) for k, i in enumerate(ids)])
    reader = _Database(con)
    read_database_table(reader, "jdbc:x", "Lines", TableSplit("OrderID", rows=500), {"user": "u"}, "OrderID BIGINT")
    conditions = reader.asked["predicates"]
    sizes = [con.execute(f"SELECT count(*) FROM Lines WHERE {c}").fetchone()[0] for c in conditions]
    assert sum(sizes) == len(ids) and len(reader.queries) == 1 and reader.asked["customSchema"] == "OrderID BIGINT"
    assert 18 <= len(sizes) <= 23 and max(sizes) <= 1200 and sorted(sizes)[-2] <= 520


def test_a_table_of_one_range_or_none_is_read_at_once():
    con = importlib.import_module("sqlite3").connect(":memory:")
    con.execute("CREATE TABLE T (a BIGINT)")
    for _ in range(2):
        reader = _Database(con)
        read_database_table(reader, "jdbc:x", "T", TableSplit("a", rows=10))
        assert "predicates" not in reader.asked and reader.asked["dbtable"] == "T"
        con.execute("INSERT INTO T VALUES (1), (2)")


def test_order_tables_are_read_by_rows_unless_told_otherwise():
    from salesmarts import PipelineConfig

    assert PipelineConfig().split("orders") == TableSplit("OrderID", rows=1_000_000)
    assert PipelineConfig(database_rows=50).split("orderdetails").rows == 50
