import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesflow.plans.coverage import coverage_orders
from salesflow.plans.history import combined, read_history, save_months, seed_history
from salesflow.plans.master_data import market_masters, report_masters
from salesflow.plans.sell_through import compile_sheets
from salesflow.operators.filters import quarter_scope, sale_window, source_tags
from salesflow.sources.files import list_files, read_delimited_master, read_facts, read_text_csvs, select_files
from salesflow.sources.grid import grid_to_table, promote_header, visible_sheets
from salesflow.sources.sinks import write_exceptions, write_report_parts, write_union


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_csvs_with_different_headers_meet_by_name(spark, tmp_path):
    (tmp_path / "b_order_number.csv").write_text('City,Province,Note\nBandung,West,"two\nlines, ""q"""\nNA,nan,\n')
    (tmp_path / "a_order_number.csv").write_text("Province,City\nEast, Surabaya \n")
    (tmp_path / "c_empty.csv").write_text("Other\n")
    files = list_files(spark, str(tmp_path), ".csv")
    assert [f.rsplit("/", 1)[1] for f in files] == ["a_order_number.csv", "b_order_number.csv", "c_empty.csv"]
    out = read_text_csvs(spark, files, stem_col="stem", skip_empty=True)
    assert rows(out.select("stem", "Province", "City", "Note")) == Counter(
        [("a", "East", " Surabaya ", None), ("b", "West", "Bandung", 'two\nlines, "q"'), ("b", None, None, None)]
    )
    assert "Other" in read_text_csvs(spark, files).columns


def test_csvs_with_a_line_break_in_the_header_meet_by_name(spark, tmp_path):
    (tmp_path / "a_1.csv").write_text('"Order\nNo",City,Province\n1,Bandung,West\n')
    (tmp_path / "b_1.csv").write_text('"Order\nNo",Province,City\n2,East,Surabaya\n')
    (tmp_path / "c_1.csv").write_text('"Order\nNo",Other\n')
    files = list_files(spark, str(tmp_path), ".csv")
    out = read_text_csvs(spark, files, stem_col="stem", skip_empty=True)
    assert rows(out.select("stem", "Order\nNo", "City", "Province")) == Counter(
        [("a", "1", "Bandung", "West"), ("b", "2", "Surabaya", "East")]
    )
    assert "Other" not in out.columns
    assert "Other" in read_text_csvs(spark, files).columns


def test_delimited_master_with_bom_bad_bytes_and_padded_header(spark, tmp_path):
    path = tmp_path / "master.csv"
    path.write_bytes(b"\xef\xbb\xbfCity ; ADM1\nBandung;W\xffst\n;None\n")
    out = read_delimited_master(spark, str(path), ";", ["City", "ADM1"])
    assert rows(out) == Counter([("Bandung", "W�st"), (None, None)])
    with pytest.raises(ValueError, match="ADM2"):
        read_delimited_master(spark, str(path), ";", ["ADM2"])


def test_select_files(spark):
    names = ["1. A Sell Through.xlsx", "COPY-1. A Sell Through.xlsx", "12. B sell through.XLSX", "2. C Report.xlsx"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    from salesflow.sources.files import REGIONAL_NAME

    assert {r[0] for r in select_files(df, "n", include=REGIONAL_NAME).collect()} == {names[0], names[2]}
    assert {r[0] for r in select_files(df, "n", keyword="SELL", exclude=["copy"]).collect()} == {names[0], names[2]}


def test_source_tags_roll_over_the_year():
    assert source_tags(2026, 2) == ["26 01 Jan", "26 02 Feb", "26 03 Mar", "25 12 Dec (3)"]
    assert source_tags(2026, 9) == ["26 07 Jul", "26 08 Aug", "26 09 Sep", "26 06 Jun (3)"]


def test_quarter_scope_lists_names_for_the_scan(spark, tmp_path):
    names = ["26 09 Sep (1) Report.xlsx", "26 06 jun (3) report.xlsx", "26 06 Jun (2) Report.xlsx",
             "~$26 09 Sep Report.xlsx", "26 09 Sep.xlsx", None]
    spark.createDataFrame([(n,) for n in names], "Source string").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    for limit in (None, 10, 1):
        assert {r[0] for r in quarter_scope(table, "Source", 2026, 9, limit).collect()} == set(names[:2])
    plan = quarter_scope(table, "Source", 2026, 9, 10)._jdf.queryExecution().executedPlan().toString()
    assert "In(Source, [" in plan.split("PushedFilters")[1]


def test_sale_window_reaches_the_scan(spark, tmp_path):
    spark.sql(
        "SELECT * FROM VALUES (timestamp_ntz'2026-09-30 23:59:59', null), (null, timestamp_ntz'2026-09-01 00:00:00'),"
        " (timestamp_ntz'2026-10-01 00:00:00', timestamp_ntz'2026-09-05 00:00:00'), (null, null) AS t(SentOn, CreatedOn)"
    ).write.parquet(str(tmp_path / "t"))
    kept = spark.read.parquet(str(tmp_path / "t")).filter(
        sale_window("SentOn", "CreatedOn", dt.date(2026, 9, 1), dt.date(2026, 10, 1))
    )
    assert kept.count() == 2
    pushed = kept._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    assert "Or(And(GreaterThanOrEqual(SentOn" in pushed and "And(IsNull" in pushed


GRID = "source_file string, sheet string, sheet_no int, sheet_state string, row_no int, cells array<string>, cell_types array<string>"


def sheet(book, name, no, state, header, *data):
    lines = [(header, ["text"] * len(header)), *data]
    return [(book, name, no, state, i, c, k) for i, (c, k) in enumerate(lines)]


def test_grid_by_position_and_by_header(spark):
    grid = spark.createDataFrame(
        sheet("m.xlsx", "P", 0, "visible", ["x", "y"], (["1.0", "a"], ["float", "text"]), (["2"], ["int"])), GRID
    )
    assert rows(grid_to_table(grid, {"a": 0, "b": 1}, skip=1)) == Counter([(1, "1", "a"), (2, "2", None)])
    assert rows(promote_header(grid, ["y", "x"])) == Counter([(1, "a", "1"), (2, None, "2")])
    with pytest.raises(ValueError):
        promote_header(grid, ["z"])


def test_compile_sheets(spark):
    t = "text"
    data = [
        *sheet("1. A Sell Through.xlsx", "S", 0, "visible", ["KLASIFIKASI OUTLET ", "Date", "Total", None, "Date"],
               (["a\nb ", "45597", "12", "junk", "x"], [t, "int", "int", t, t]),
               ([" ", "13/10/2026", "n/a", None, None], [t, t, t, "empty", "empty"])),
        *sheet("2. B Sell Through.xlsx", "S", 0, "visible", ["Quantity", "Date", " KLASIFIKASI OUTLET", "Unnamed: 3"],
               (["5", "2026-01-02T00:00:00", "c"], [t, "datetime", t]), ([None, "99/99/2026", None, "z"], ["empty", t, "empty", t])),
        *sheet("2. B Sell Through.xlsx", " MASTER_DATA", 1, "visible", ["Other"], (["1"], [t])),
        *sheet("2. B Sell Through.xlsx", "H", 2, "hidden", ["Total"], (["1"], [t])),
        *sheet("COPY 2. B Sell Through.xlsx", "S", 0, "visible", ["Total"], (["1"], [t])),
    ]
    grid = spark.createDataFrame(data, GRID)
    assert visible_sheets(grid).select("sheet").distinct().count() == 1
    out = compile_sheets(grid)
    assert out.columns == ["KLASIFIKASI OUTLET", "Date", "Total", "Date.1", "SourceFile", "SheetName", "Quantity"]
    a, b = "1. A Sell Through.xlsx", "2. B Sell Through.xlsx"
    assert rows(out) == Counter([
        ("a b", "2024-11-01", 12.0, "x", a, "S", None), ("", "2026-10-13", 0.0, None, a, "S", None),
        ("c", "2026-01-02", 0.0, None, b, "S", "5"), (None, "", 0.0, None, b, "S", None),
    ])
    assert "nan" in {r["KLASIFIKASI OUTLET"] for r in compile_sheets(grid, blank_as_text=True).collect()}


def test_months_replace_only_themselves(spark, tmp_path):
    path = str(tmp_path / "months")
    first = spark.sql("SELECT * FROM VALUES ('a', '2026-08-01', '1'), ('b', '2026-09-01', '2') AS t(NoPesanan, SentOn, Quantity)")
    save_months(first, path)
    save_months(spark.sql("SELECT 'c' AS NoPesanan, '2026-09-02' AS SentOn, '3.9' AS Quantity, 'x' AS extra"), path)
    months = [spark.read.parquet(f"{path}/sale_month={m}") for m in ("2026-08", "2026-09")]
    out = combined(months)
    expected = Counter([("a", 1, "", None), ("c", 3, "", "x")])
    assert rows(out.select("NoPesanan", "Quantity", "City", "extra")) == expected
    stacked = read_history(spark, path)
    assert rows(stacked.select("NoPesanan", "Quantity", "City", "extra")) == expected
    assert {r["sale_month"] for r in stacked.collect()} == {"2026-08", "2026-09"}


def test_report_parts_replace_the_month(spark, tmp_path):
    path = str(tmp_path / "parts")
    two = spark.sql("SELECT * FROM VALUES ('2026-09', 'p (1)', 1), ('2026-09', 'p (2)', 2), ('2026-08', 'q', 3) AS t(sale_month, part_name, n)")
    write_report_parts(two, path)
    write_report_parts(two.filter("n = 1"), path)
    assert rows(spark.read.parquet(path).select("part_name", "n")) == Counter([("p (1)", 1), ("q", 3)])


def test_seed_history_by_stem(spark, tmp_path):
    source = tmp_path / "csv"
    source.mkdir()
    (source / "2025 06 Jun_Offline.csv").write_text("NoPesanan,SentOn,Quantity\n1,2025-06-03,2\n")
    (source / "2025 06 Jun_Online.csv").write_text("SentOn,NoPesanan\n2025-06-04,2\n")
    (source / "2025 07 Jul_Offline.csv").write_text("NoPesanan,SentOn\n3,2025-07-01\n")
    (source / "2025 Report.csv").write_text("NoPesanan\n9\n")
    path = str(tmp_path / "months")
    seed_history(spark, str(source), path, only=["2025 06 Jun"])
    assert rows(spark.read.parquet(path).select("sale_month", "NoPesanan", "Quantity")) == Counter(
        [("2025-06", "1", 2), ("2025-06", "2", 0)]
    )
    rebuilt = spark.sql("SELECT '7' AS NoPesanan, '2025-06-09' AS SentOn, '5' AS Quantity")
    save_months(rebuilt, path, months=["2025-06"])
    assert rows(read_history(spark, path).select("sale_month", "NoPesanan", "Quantity")) == Counter([("2025-06", "7", 5)])
    save_months(rebuilt.filter("NoPesanan = ''"), path, months=["2025-06"])
    save_months(rebuilt.withColumn("SentOn", F.lit("2025-07-01")), path, months=["2025-07"])
    assert rows(read_history(spark, path).select("sale_month", "NoPesanan")) == Counter([("2025-07", "7")])
    (source / "no month.csv").write_text("NoPesanan\n9\n")
    with pytest.raises(ValueError, match="no month"):
        seed_history(spark, str(source), path)


def test_coverage_orders_end_to_end(spark, tmp_path):
    source = tmp_path / "csv"
    source.mkdir()
    (source / "Sales_Order_Number_1.csv").write_text("Province,City,o\nP, A ,1\nP, A ,1\nP,Q,2\n")
    (source / "sales_order_number_2.csv").write_text("City,Province\n,P\n")
    (source / "other.csv").write_text("City\nzzz\n")
    master = tmp_path / "m.csv"
    master.write_text("City;ADM2_NAME (STANDARDIZED);ADM1\nA;STD A;X\nA;wrong;Y\n;BLANK;Z\n")
    out, listed = str(tmp_path / "out"), str(tmp_path / "unmatched")
    missing = coverage_orders(spark, str(source), str(master), out, listed)
    assert [tuple(r) for r in missing.collect()] == [("P", "Q")]
    assert rows(spark.read.parquet(out)) == Counter(
        [("P", " A ", "1", "STD A", "X"), ("P", "Q", "2", "-", "-"), ("P", None, None, "BLANK", "Z")]
    )
    assert rows(spark.read.csv(listed, header=True)) == Counter([("P", "Q")])


def test_write_union_counts_and_facts_prune(spark, tmp_path):
    path = str(tmp_path / "u")
    assert write_union(spark.range(123).withColumn("x", F.lit(1)), path) == 123
    plan = read_facts(spark, path, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan
    with pytest.raises(ValueError):
        read_facts(spark, path, ["gone"])
    write_exceptions(spark.sql("SELECT cast(null AS string) AS a, 'b' AS b"), str(tmp_path / "e"))


def test_masters_from_the_workbook(spark):
    t = "text"

    def plain(name, *lines):
        return [("m.xlsx", name, 0, "visible", i, c, [t if v else "empty" for v in c]) for i, c in enumerate(lines)]

    heading = [["", "Products"], [""], ["No", "ItemName", "Brand", "Category", "Sub Category", "Variant", "Product Name", "Type of Item"]]
    grid = spark.createDataFrame(
        [
            *plain("Product", *heading, ["1", "Tea", "b", "c", "s", "v", "p", "Reguler"], ["2", "Tea", "b2", "c", "s", "v", "p"]),
            *plain("Area", [], [], [], [], [""], ["", "Bandung", "R1", "WEST"], ["", "x", "R0", "0"], ["", "y", "R2", "WEST"]),
            *plain("Channel", ["Sub Channel", "SalesType", "Channel Group", "Channel", "SubSalesType"], ["s", " SHOP ", "ONLINE", "E", ""]),
            *plain("Kode Pos", ["Kode Pos", "Area Level 1", "Area Level 2"], [" 10 ", "P", "C"], ["", "P", "C"]),
        ],
        GRID,
    )
    product, area, channel = report_masters(grid)
    assert rows(product.select("ItemName", "Brand", "Type of Item")) == Counter([("TEA", "b", "Reguler")])
    assert rows(area) == Counter([("WEST", "R1")])
    assert rows(channel) == Counter([(" SHOP ", None, "ONLINE", "E", "s")])
    market = market_masters(grid)
    assert rows(market.postcode) == Counter([("10", "P", "C")])
    assert rows(market.channel.select("SalesType")) == Counter([("SHOP",)])
    assert rows(market.product.select("Brand", "Type of Item")) == Counter([("B", "REGULER"), ("B2", None)])
