import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill.functions.dates import period
from tidemill.operators import relational as R
from tidemill.plans import reports
from tidemill.sources.tpch import read_tbl

LINEITEM = """1|1|1|1|10|100.00|0.10|0.05|N|O|1996-01-01||||||
1|2|9|2|20|200.00|0.00|0.00|N|O|1996-01-15||||||
2|1|1|1|5|50.00|0.20|0.10|R|F|1996-02-01||||||
"""
ORDERS = """1|1|O|0|1995-12-20|5-LOW|Clerk#1|0||
2|1|O|0|1996-01-20|5-LOW|Clerk#2|1||
3|2|O|0|1996-01-20|5-LOW|Clerk#3|1||
"""
OTHERS = {
    "customer": "1|Ann||3||0|B||\n2|Bob||4||0|B||\n",
    "part": "1|bolt|||||||0||\n2|nut|||||||0||\n",
    "supplier": "1|Acme||3||0||\n",
    "nation": "3|CANADA|1||\n24|UNITED STATES|1||\n",
}


@pytest.fixture(scope="module")
def t(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tbl")
    tables = {"lineitem": LINEITEM, "orders": ORDERS, **OTHERS}
    for name, text in tables.items():
        (folder / f"{name}.tbl").write_text(text)
    return {name: read_tbl(spark, str(folder / f"{name}.tbl"), name) for name in tables}


def test_tbl_scan(t):
    row = t["lineitem"].orderBy("l_orderkey", "l_linenumber").first()
    assert (row.l_orderkey, row.l_tax, row.l_returnflag, row.l_shipdate) == (1, 0.05, "N", dt.date(1996, 1, 1))
    assert t["orders"].filter("o_clerk = 'Clerk#2'").first().o_shippriority == 1


@pytest.mark.parametrize("date, n", [("1996-01", 2), ("1996", 3), ("1996-01-01", 1), ("1997", 0)])
def test_ship_count(t, date, n):
    assert reports.ship_count(t["lineitem"], date).first()[0] == n


def test_clerks(t, rows):
    assert rows(reports.clerks(t["orders"], t["lineitem"], "1996-01")) == [("Clerk#1", 1)]
    assert rows(reports.clerks(t["orders"], t["lineitem"], "1996", limit=None)) == [("Clerk#1", 1), ("Clerk#2", 2)]


@pytest.mark.parametrize("limit", [20, None])
def test_parts_suppliers(t, limit):
    got = reports.parts_suppliers(t["lineitem"], t["part"], t["supplier"], "1996-01", limit).collect()
    assert [tuple(r) for r in got] == [(1, "bolt", "Acme"), (1, "nut", "?")]


def test_nation_volume(t, rows):
    args = t["lineitem"], t["orders"], t["customer"], t["nation"]
    assert rows(reports.nation_volume(*args, "1996")) == [(3, "CANADA", 3)]
    assert rows(reports.monthly_volume(*args)) == [("CANADA", "1996-01", 2), ("CANADA", "1996-02", 1)]


def test_unknown_nation(t, rows):
    nobody = t["nation"].filter("n_nationkey = 24")
    assert rows(reports.nation_volume(t["lineitem"], t["orders"], t["customer"], nobody, "1996")) == [(3, "?", 3)]


def test_pricing_summary(t):
    got = [tuple(r) for r in reports.pricing_summary(t["lineitem"], "1996-01").collect()]
    assert got == [("N", "O", 30.0, 300.0, 290.0, 294.5, 15.0, 150.0, 0.05, 2)]


def test_shipping_priority(t):
    args = t["lineitem"], t["orders"], t["customer"]
    assert reports.shipping_priority(*args, "1996-01").collect() == []
    got = [tuple(r) for r in reports.shipping_priority(*args, "1995-12-31").collect()]
    assert got == [("Ann", 1, 290.0, "1995-12-20", 0)]


def test_periods():
    assert period("1996") == (dt.date(1996, 1, 1), dt.date(1997, 1, 1))
    assert period("1996-12") == (dt.date(1996, 12, 1), dt.date(1997, 1, 1))
    assert period("1996-02-29") == (dt.date(1996, 2, 29), dt.date(1996, 3, 1))
    for bad in ("1996-1", "96", "1996-01-01-01", "1996-13", ""):
        with pytest.raises(ValueError):
            period(bad)


def test_dates_kept_as_text(t):
    text = t["lineitem"].withColumn("l_shipdate", F.col("l_shipdate").cast("string"))
    assert reports.ship_count(text, "1996-01").first()[0] == 2


def test_date_range_reaches_the_scan(spark):
    lineitem = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = reports.ship_count(lineitem, "1996-01")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    assert "ReadSchema: struct<l_shipdate" in plan


def test_lookups(t, rows):
    li = t["lineitem"].select("l_orderkey", "l_suppkey")
    assert rows(R.lookup(li, t["supplier"].select("s_suppkey"), "l_suppkey", "s_suppkey")) == [(1, 1, 1), (2, 1, 1)]
    named = R.lookup_or(li, t["supplier"], "l_suppkey", "s_suppkey", "s_name").select("l_suppkey", "s_name")
    assert rows(named) == [(1, "Acme"), (1, "Acme"), (9, "?")]
    assert rows(R.keep_members(li, t["supplier"], "l_suppkey", "s_suppkey")) == [(1, 1), (2, 1)]
