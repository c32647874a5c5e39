"""Statements are judged by their plan, and none of them runs."""

import pytest

from brightloom.sources.audit import audit_statement

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def views(spark):
    for t in ("orders", "customer"):
        spark.read.parquet(f"{SF}/{t}.parquet").createOrReplaceTempView(f"au_{t}")
    return spark


def rows(spark, sql):
    return audit_statement(spark, sql).collect()


def test_filters_and_columns_of_a_scan(views):
    out = rows(views, "SELECT o_orderkey FROM au_orders WHERE o_totalprice > 1000")
    scan = next(r for r in out if r["node"] == "Scan")
    assert scan["relation"] == "orders.parquet" and "o_totalprice" in scan["pushed_filters"] and scan["warning"] is None and scan["estimated_bytes"] > 0
    assert out[0]["relation"] == "au_orders"


def test_unpruned_scans_are_flagged(views):
    assert [r["warning"] for r in rows(views, "SELECT * FROM au_orders") if r["node"] == "Scan"] == ["reads all rows and columns"]
    assert [r["warning"] for r in rows(views, "SELECT o_custkey FROM au_orders") if r["node"] == "Scan"] == ["reads all rows"]


def test_joins_of_all_pairs_are_flagged(views):
    def warned(sql):
        return [r["warning"] for r in rows(views, sql) if "Join" in r["node"] or "Cartesian" in r["node"]]

    assert warned("SELECT count(*) FROM au_orders CROSS JOIN au_customer") == ["compares all pairs of rows"]
    assert warned("SELECT count(*) FROM au_orders JOIN au_customer ON o_custkey > c_custkey") == ["compares all pairs of rows"]
    assert warned("SELECT count(*) FROM au_orders JOIN au_customer ON o_custkey = c_custkey") == [None]


@pytest.mark.parametrize(
    "sql", ["DROP VIEW au_orders", "DROP TABLE au_orders", "INSERT INTO au_orders SELECT * FROM au_orders", "DELETE FROM au_orders", "UPDATE au_orders SET o_custkey = 1", "TRUNCATE TABLE au_orders", "CREATE TABLE au_new (a INT) USING parquet", "SET spark.sql.ansi.enabled=false"],
)
def test_writes_are_flagged_and_do_not_run(views, sql):
    before = views.conf.get("spark.sql.ansi.enabled")
    (row,) = rows(views, sql)
    assert row["warning"] == "changes data, tables or settings" and ("au_" in sql) == ("au_" in (row["relation"] or ""))
    assert views.table("au_orders").count() > 0 and not views.catalog.tableExists("au_new") and views.conf.get("spark.sql.ansi.enabled") == before


def test_statements_that_cannot_be_planned(views):
    assert rows(views, "SELEC 1")[0]["node"] == "Invalid"
    assert "nowhere" in rows(views, "SELECT * FROM nowhere")[0]["warning"]


def test_words_in_texts_are_no_writes(views):
    out = rows(views, "SELECT 'drop table x; delete' AS t FROM au_orders WHERE o_orderpriority = 'UPDATE'")
    assert out[0]["warning"] is None
