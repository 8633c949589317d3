import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from salesflow.plans.chain import build_months
from salesflow.plans.history import read_history
from salesflow.plans.marketplace import Masters, marketplace_month
from salesflow.plans.quality import (
    build_decision, compile_check, expected_units, freshness, promotion_check, release_compare, units_guard,
)
from salesflow.plans.sell_in import (
    clean_accounting, clean_erp, clean_stock, lost_marketplace, marketplace_rows, month_report, month_rows, offline_base,
)
from salesflow.schemas import MARKETPLACE_COLUMNS, REPORT_COLUMNS


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def erp_feed(spark):
    return spark.sql("""
        SELECT '2026-09-01' AS CreatedOn, sent AS SentOn, date'2026-09-02' AS InvoiceOn, 2.5D AS Quantity,
               'Bali (ID)' AS CustomerState, 'denpasar' AS CustomerCity, 'shop' AS CustomerName, 'gt' AS CustomerLevel1,
               sub AS CustomerLevel2, 'tea' AS ItemName, ref AS OrderReference, 'full' AS `Delivery Status`,
               '30' AS `Payment Terms`, 'x' AS `Customer & Address`, checked AS Checked, 'open' AS Status
        FROM VALUES ('2026-09-03', 'a', null, 'r1'), ('2026-09-03', 'a', 'Reported', 'r2'),
                    ('03/09/2026', null, 'reported', 'r3'), ('2024-12-31', 'a', '', 'r4'), (null, 'a', '', 'r5'),
                    ('2026-09-20 08:00:00', 'on', '', 'r6') AS t(sent, sub, checked, ref)""")


def test_clean_erp_drops_by_the_rules(spark):
    out = clean_erp(erp_feed(spark), "erp")
    assert rows(out.select("NoPesanan", "SentOn", "Province", "SubSalesType", "Quantity", "Status", "ReportSource")) == Counter(
        [("R3", dt.date(2026, 9, 3), "BALI", None, 2, "FULL", "ERP"), ("R6", dt.date(2026, 9, 20), "BALI", "ON", 2, "FULL", "ERP")]
    )


def stock(spark):
    feed = spark.sql("""
        SELECT timestamp_ntz'2026-09-01 10:00:00' AS CreatedOn, sent AS SentOn, 'gt' AS SalesType, 'x' AS City,
               no AS NoPesanan, 'Shop' AS CustomerName, item AS ItemName, q AS Quantity
        FROM VALUES ('2026-09-05', 1234567890D, 'tea', 1.5D), ('n/a', 2D, null, 0.5D) AS t(sent, no, item, q)""")
    return clean_stock(feed, "Stock")


def test_clean_stock(spark):
    assert rows(stock(spark).select("SentOn", "NoPesanan", "Quantity", "ItemName", "ReportSource")) == Counter(
        [(dt.date(2026, 9, 5), "1234567890", 2, "TEA", "STOCK"), (None, "2", 0, None, "STOCK")]
    )


def accounting(spark):
    feed = spark.sql("""
        SELECT date'2026-09-01' AS CreatedOn, date'2026-09-30' AS SentOn, 's1' AS `SO Number`, 'd1' AS `DO Number`,
               'gt' AS `Sales Type`, c AS Customer, p AS Province, 'c' AS City, 'tea' AS `Item Name`, 1 AS `Qty Sales`,
               9.75D AS Revenue, 0 AS `Qty Return`, 1D AS Quantity
        FROM VALUES ('employee Budi', 'A'), (null, 'A'), ('Shop', null) AS t(c, p)""")
    return clean_accounting(feed, "ACCOUNTING")


def test_clean_accounting_drops_employees_and_nameless(spark):
    assert rows(accounting(spark).select("CustomerName", "NoPesanan")) == Counter([("SHOP", "D1")])


def base(spark):
    product = spark.sql("SELECT * FROM VALUES ('TEA','b','c','s','v','p','t'), (null,'bn','c','s','v','p','t') AS t(ItemName, Brand, Category, SubCategory, Variant, `Product Name`, `Type of Item`)")
    area = spark.sql("SELECT * FROM VALUES ('BALI','East'), (null,'Nowhere') AS t(Province, Region)")
    channel = spark.sql("SELECT * FROM VALUES ('GT',null,'OFFLINE','C1','S'), ('GT',null,null,'C2','S'), ('GT','ON','ONLINE','C3','S') AS t(SalesType, SubSalesType, `Channel Group`, Channel, `Sub Channel`)")
    return offline_base([stock(spark), clean_erp(erp_feed(spark), "erp"), accounting(spark)], product, area, channel)


def test_offline_base_matches_null_keys_and_multiplies(spark):
    out = base(spark)
    # Three rows without a sub type meet two channel rows each; one row meets one.
    found = Counter(r["ReportSource"] for r in out.collect())
    assert found == Counter({"STOCK": 4, "ERP": 3, "ACCOUNTING": 2})
    assert {(r["Region"], r["Brand"]) for r in out.collect()} == {("Nowhere", "b"), ("Nowhere", "bn"), ("East", "b")}


def market_inputs(spark):
    orders = spark.sql("""
        SELECT src AS Source, mp AS Marketplace, timestamp_ntz'2026-09-01 09:00:00' AS CreatedOn, sent AS SentOn,
               no AS `Order Number`, item AS `Item Name`, st AS `Order Status`, pc AS `Shipping Postcode`,
               qty AS `Ordered Quantity`, '5' AS `Unit Price`
        FROM VALUES
          ('26 09 Sep Report', 'X_SHOP', timestamp_ntz'2026-09-16 23:00:00', 'd14', 'Tea', 'DISPATCHED', '10', '12.7'),
          ('26 09 Sep Report', 'X_SHOP', timestamp_ntz'2026-09-17 00:00:00', 'd13', 'Tea', 'DISPATCHED', '10', '1'),
          ('26 09 Sep Report', 'X_NEXUS', null, 'nosent', null, 'DELIVERED ', null, '1d'),
          ('26 01 Jan Report', 'SHOP', timestamp_ntz'2026-09-30 23:59:59', 'nosuffix', 'Cup', 'DELIVERED', ' 10', null),
          ('26 09 Sep Report', 'X_SHOP', timestamp_ntz'2026-10-01 00:00:00', 'oct', 'Tea', 'DELIVERED', '10', '1'),
          ('26 09 Sep Report', 'X_SHOP', timestamp_ntz'2026-09-05 00:00:00', 'gift', 'Gift', 'DELIVERED', '10', '1'),
          ('26 09 Sep Report', 'X_SHOP', timestamp_ntz'2026-09-05 00:00:00', 'void', 'Tea', 'CANCELLED', '10', '1')
        AS t(src, mp, sent, no, item, st, pc, qty)""")
    masters = Masters(
        spark.sql("SELECT * FROM VALUES ('10','Bali',cast(null AS string)) AS t(`Kode Pos`, Province, City)"),
        spark.sql("SELECT * FROM VALUES ('ONLINE','SHOP','E','S1'), ('ONLINE','SHOP','E','S2') AS t(`Channel Group`, SalesType, Channel, `Sub Channel`)"),
        spark.sql("SELECT * FROM VALUES ('TEA','B','C','S','V','P','REGULER'), ('GIFT','B','C','S','V','P','BONUS'), (null,'BN','C','S','V','P',null) AS t(ItemName, Brand, Category, SubCategory, Variant, `Product Name`, `Type of Item`)"),
    )
    return orders, masters


def market(spark, as_of=dt.date(2026, 9, 30), scope="all"):
    return marketplace_month(*market_inputs(spark), 2026, 9, as_of, scope)


def test_marketplace_month(spark):
    out = market(spark)
    assert out.columns == MARKETPLACE_COLUMNS
    got = rows(out.select("NoPesanan", "SentOn", "SalesType", "Quantity", "Province", "City", "Sub Channel", "Brand"))
    d = dt.date
    assert got == Counter([
        ("d14", d(2026, 9, 16), "SHOP", 12, "Bali", "-", "S1", "B"), ("d14", d(2026, 9, 16), "SHOP", 12, "Bali", "-", "S2", "B"),
        ("nosent", d(2026, 9, 1), "ENDORSE", 0, "-", "-", None, "BN"), ("nosuffix", d(2026, 9, 30), "", 0, "-", "-", None, None),
    ])
    assert {r["NoPesanan"] for r in market(spark, scope="quarter").collect()} == {"d14", "nosent"}


def test_month_rows_and_report(spark):
    own, foreign = base(spark), marketplace_rows(market(spark), "market")
    out = month_rows(own, foreign, 2026, 9)
    assert out.columns == [*REPORT_COLUMNS, "side"]
    sides = Counter((r["side"], r["ReportSource"]) for r in out.collect())
    # A null channel group is offline; marketplace rows without a channel are in neither part.
    assert sides == Counter({("Offline", "STOCK"): 2, ("Offline", "ERP"): 2, ("Online", "ERP"): 1, ("Offline", "ACCOUNTING"): 2, ("Online", "MARKET"): 2})
    assert {r["CustomerName"] for r in out.filter("ReportSource = 'MARKET'").collect()} == {"SHOP"}
    assert out.filter("Revenue = 9.75").count() == 2
    assert rows(lost_marketplace(foreign).select("SalesType", "rows")) == Counter([("ENDORSE", 1), ("", 1)])
    parts = month_report(own, foreign, 2026, 9)
    names = Counter(r["part_name"] for r in parts.collect())
    assert names == Counter({"2026 09 Sep Offline": 6, "2026 09 Sep Online (2)": 3})


def test_build_months_rebuilds_only_what_it_is_given(spark, tmp_path):
    report, history = str(tmp_path / "report"), str(tmp_path / "history")
    orders, masters = market_inputs(spark)

    def build(months, source):
        build_months(base(spark), orders, masters, months, dt.date(2026, 10, 31), source, report, history)

    build([(2026, 9), (2026, 10)], "first")
    build([(2026, 10)], "second")
    parts = spark.read.parquet(report)
    # By the end of October the order that was too young counts too.
    assert Counter(r["part_name"] for r in parts.collect()) == Counter(
        {"2026 09 Sep Offline": 6, "2026 09 Sep Online (2)": 5, "2026 10 Oct Online (1)": 2}
    )
    stacked = read_history(spark, history)
    assert set(REPORT_COLUMNS) <= set(stacked.columns)
    found = Counter((r["sale_month"], r["ReportSource"]) for r in stacked.filter("Channel = 'E'").collect())
    assert found == Counter({("2026-09", "FIRST"): 4, ("2026-10", "SECOND"): 2})
    assert {r["Revenue"] for r in stacked.collect()} == {0, 9}


def test_expected_units_drop_null_types_and_use_the_last_part(spark):
    orders = spark.sql("""
        SELECT mp AS Marketplace, st AS `Order Status`, timestamp_ntz'2026-09-01 00:00:00' AS CreatedOn,
               cast(null AS timestamp_ntz) AS SentOn, ty AS `Type of Item`, 10 AS `Ordered Quantity`
        FROM VALUES ('a_b_lazada', 'Delivered', 'Reguler'), ('a_lazada', 'delivered', null), ('lazada', 'DELIVERED', 'activity'),
                    ('a_x', 'DELIVERED', 'ACTIVITY'), ('a_lazada', 'dispatched', 'ACTIVITY') AS t(mp, st, ty)""")
    assert rows(expected_units(orders, dt.date(2026, 9, 14))) == Counter([("2026-09", 20)])
    assert rows(expected_units(orders, dt.date(2026, 9, 15))) == Counter([("2026-09", 30)])


def test_units_guard_needs_both_tolerances(spark):
    e = spark.sql("SELECT * FROM VALUES ('2026-01', 1000000L), ('2026-02', 1000L), ('2026-03', 398000L), ('2024-12', 5L) AS t(ym, expected)")
    a = spark.sql("SELECT * FROM VALUES ('2026-01', 1004999L), ('2026-02', 1400L), ('2026-03', 547000L), ('2026-04', 501L) AS t(ym, actual)")
    assert {r["ym"]: r["bad"] for r in units_guard(e, a).collect()} == {"2026-01": False, "2026-02": False, "2026-03": True, "2026-04": True}


def test_release_compare_cuts_the_old_table_to_the_month(spark):
    cols = "t(ReportSource, SentOn, Quantity, `Qty Sales`, Revenue, `Qty Return`)"
    new = spark.sql(f"SELECT * FROM VALUES ('A', date'2026-09-01', 1, null, 1, 0), ('A', date'2026-09-02', 1, null, 1, 0), ('B', date'2026-10-01', 1, 0, 1, 0) AS {cols}")
    old = spark.sql(f"SELECT * FROM VALUES ('A', date'2026-09-09', 2, null, 2, 0), ('A', date'2026-09-10', 0, null, 0, 0), ('B', date'2026-10-01', 1, 0, 1, 0) AS {cols}")
    assert {r["ReportSource"]: r["status"] for r in release_compare(new, old).collect()} == {"A": "MATCH", "B": "DIFF"}


def test_promotion_check(spark):
    old = spark.range(100).select(F.lit(dt.date(2026, 9, 9)).alias("SentOn"), F.lit(1).alias("b"))
    assert promotion_check(old, old).count() == 0
    assert promotion_check(old.limit(95), old).count() == 0
    bad = old.limit(94).select(F.lit(dt.date(2026, 9, 8)).alias("SentOn"), F.lit(1).alias("ok"), F.lit(1).alias("no"))
    assert rows(promotion_check(bad, old, ["ok"])) == Counter(
        [("unexpected", "no"), ("dropped", "b"), ("rows", "94"), ("newest", "2026-09-08")]
    )
    empty = old.filter("b = 2")
    assert {r["rule"] for r in promotion_check(empty, old).collect()} == {"rows"}
    assert promotion_check(old.drop("SentOn"), old.drop("SentOn"), date_col=None).count() == 0


def test_compile_check(spark):
    old = spark.range(100).select((F.col("id") % 2).cast("string").alias("SourceFile"), F.lit("2026-01-01").alias("Date"))
    assert compile_check(old, old).count() == 0
    new = old.filter("SourceFile = '1'").select(F.when(F.rand(1) < 2, F.lit("")).alias("Date"), F.lit("9").alias("SourceFile"))
    assert {r["rule"] for r in compile_check(new, old).collect()} == {"file missing", "file new", "columns", "rows", "dates"}
    undated = old.drop("Date")
    assert {r["rule"] for r in compile_check(undated, undated).collect()} == {"dates"}


NOW = dt.datetime(2026, 9, 9, 12)
LIMITS = {"erp": dt.timedelta(hours=3), "market": dt.timedelta(hours=8)}


def decide(spark, updates, last, **more):
    data = [(name, NOW - dt.timedelta(hours=h)) for name, h in updates.items()]
    log = spark.createDataFrame(data, "dataset string, ts timestamp_ntz")
    out = build_decision(freshness(log, LIMITS, NOW, last), NOW, last, "market", **more).first()
    return out["run"], out["reason"]


def test_freshness_and_decision(spark):
    hours = dt.timedelta(hours=1)
    assert decide(spark, {"erp": 1, "market": 1}, None) == (True, "ready: something new and nothing stale")
    assert decide(spark, {"erp": 4, "market": 1}, NOW - 9 * hours) == (False, "wait: stale erp")
    assert decide(spark, {"erp": 1}, None) == (False, "wait: stale market")
    assert decide(spark, {"erp": 2, "market": 2}, NOW - hours)[0] is False
    assert decide(spark, {"erp": 0.2, "market": 5}, NOW - hours / 2) == (False, "skip: built lately and only slower inputs are new")
    assert decide(spark, {"erp": 5, "market": 0.2}, NOW - hours / 2) == (False, "wait: stale erp")
    assert decide(spark, {"erp": 1, "market": 0.2}, NOW - hours / 2)[0] is True
    assert decide(spark, {"erp": 1, "market": 1}, NOW - hours / 2, running=["erp"])[1] == "wait: erp is loading"
    assert decide(spark, {"erp": 1, "market": 1}, NOW - 3 * hours, running=["erp"])[0] is True
