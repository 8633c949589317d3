"""Summaries and release checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from salesflow.functions import named
from salesflow.functions.dates import month_key
from salesflow.operators.compare import (
    differing_columns, group_diff, multiset_compare, same_columns, set_diff,
)
from salesflow.operators.filters import counted, sale_day, type_filter
from salesflow.operators.summary import day_counts, dominant_month, monthly_units, profile, summarise
from salesflow.plans.figures import (
    FIGURES, month_figures, stored_figures, stored_units, version_compare,
)
from salesflow.plans.marketplace import sales_type
from salesflow.plans.quality import (
    ECOMMERCE_CHANNEL, build_decision, compile_check, expected_units, freshness, promotion_check,
    promotion_check_files, published_units, release_compare, units_guard,
)
from salesflow.plans.rebuild import touched_months
from salesflow.session import new_folder
from salesflow.sources.releases import publish, read_aside, write_months_aside
from workload import query
from workload.reports import dates_as_text
from workload.standins import (
    AS_OF, HISTORY, MARKET_FACTS, MARKET_ORDERS, spark_sale_day, table,
)


@query(
    "monthly_units",
    """
    SELECT strftime(l_shipdate, '%Y-%m') AS ym, CAST(sum(CAST(l_quantity AS bigint)) AS bigint) AS units
    FROM lineitem GROUP BY 1
    """,
)
def units_by_month(spark, sf_dir):
    return monthly_units(table(spark, sf_dir, "lineitem"), "l_shipdate", F.col("l_quantity").cast("bigint"))


@query(
    "rows_per_day",
    "SELECT o_orderdate::date::varchar AS day, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1",
)
def rows_per_day(spark, sf_dir):
    return dates_as_text(day_counts(table(spark, sf_dir, "orders"), "o_orderdate"))


METRICS = ["Quantity", "Qty Sales", "Revenue", "Qty Return"]
SUMS = ", ".join(f'CAST(coalesce(sum("{m}"), 0) AS bigint) AS "{m}"' for m in METRICS)


@query("source_summary", f'SELECT "ReportSource", count(*) AS rows, {SUMS} FROM {HISTORY.sql} GROUP BY 1')
def source_summary(spark, sf_dir):
    return summarise(HISTORY.df(spark, sf_dir), "ReportSource", METRICS)


@query(
    "dominant_month",
    """
    SELECT date_trunc('month', o_orderdate)::date::varchar AS month FROM orders
    GROUP BY date_trunc('month', o_orderdate) ORDER BY count(*) DESC, date_trunc('month', o_orderdate) LIMIT 1
    """,
)
def month_of_most(spark, sf_dir):
    return dates_as_text(dominant_month(table(spark, sf_dir, "orders"), "o_orderdate"))


@query(
    "dataset_profile",
    """
    SELECT count(*) AS rows, count(DISTINCT o_custkey) AS distinct_values, min(o_orderdate)::date::varchar AS least,
           max(o_orderdate)::date::varchar AS greatest, avg(CASE WHEN t <> '' THEN 1 ELSE 0 END) AS share_filled
    FROM (SELECT *, CASE o_orderkey % 8 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE o_orderpriority END AS t FROM orders)
    """,
)
def dataset_profile(spark, sf_dir):
    text = "CASE o_orderkey % 8 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE o_orderpriority END"
    orders = table(spark, sf_dir, "orders").withColumn("t", F.expr(text))
    return dates_as_text(profile(orders, "o_custkey", "o_orderdate", "t"))


OLD_FILES = "SELECT c_name AS f FROM customer WHERE c_custkey % 50 <> 0"
NEW_FILES = "SELECT CASE WHEN c_custkey % 60 = 1 THEN concat(c_name, ' copy') ELSE c_name END AS f FROM customer"


@query(
    "source_set_diff",
    f"""
    SELECT f, 'missing' AS side FROM (({OLD_FILES}) EXCEPT ({NEW_FILES}))
    UNION ALL SELECT f, 'new' FROM (({NEW_FILES}) EXCEPT ({OLD_FILES}))
    """,
)
def source_set_diff(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    old = customer.filter("c_custkey % 50 <> 0").select(F.col("c_name").alias("f"))
    new = customer.select(
        F.expr("CASE WHEN c_custkey % 60 = 1 THEN concat(c_name, ' copy') ELSE c_name END").alias("f")
    )
    return set_diff(old, new, "f")


LINE_COLS = {
    "l_orderkey": "l_orderkey", "l_partkey": "l_partkey", "l_linenumber": "l_linenumber",
    "cents": "cast(round(l_extendedprice * 100) as bigint)", "day": "cast(cast(l_shipdate as date) as string)",
    "flag": "l_returnflag",
}
CHANGED = "case when l_orderkey % 97 = 0 then 'X' else l_returnflag end"
KEPT = "l_orderkey % 89 <> 0"


def lines_sql(flag: str, where: str) -> str:
    cols = ", ".join(f"CAST({text} AS varchar) AS {name}" for name, text in {**LINE_COLS, "flag": flag}.items())
    return f"SELECT {cols} FROM lineitem WHERE {where}"


def lines(spark, sf_dir, flag="l_returnflag", where="true"):
    cols = [F.expr(text).alias(name) for name, text in {**LINE_COLS, "flag": flag}.items()]
    return table(spark, sf_dir, "lineitem").filter(where).select(*cols)


COUNTED_SQL = f"""
    SELECT * FROM (
        SELECT {', '.join(LINE_COLS)}, CAST(sum(a) AS bigint) AS a_rows, CAST(sum(b) AS bigint) AS b_rows
        FROM (SELECT *, 1 AS a, 0 AS b FROM ({lines_sql('l_returnflag', 'true')})
              UNION ALL SELECT *, 0, 1 FROM ({lines_sql(CHANGED, KEPT)})) GROUP BY ALL)
    WHERE a_rows <> b_rows"""


@query("multiset_compare", COUNTED_SQL)
def rows_compared(spark, sf_dir):
    return multiset_compare(lines(spark, sf_dir), lines(spark, sf_dir, CHANGED, KEPT))


MONTH_OF_LINE = "substr(cast(cast(l_shipdate as date) as string), 1, 7)"
CHANGED_IN = f"case when {MONTH_OF_LINE} in ('1996-02', '1998-11') and l_orderkey % 5 = 0 then 'X' else l_returnflag end"


@query(
    "multiset_compare_months",
    f"""
    SELECT * FROM (
        SELECT {', '.join(LINE_COLS)}, month, CAST(sum(a) AS bigint) AS a_rows, CAST(sum(b) AS bigint) AS b_rows
        FROM (SELECT *, substr(day, 1, 7) AS month, 1 AS a, 0 AS b FROM ({lines_sql('l_returnflag', 'true')})
              UNION ALL SELECT *, substr(day, 1, 7), 0, 1 FROM ({lines_sql(CHANGED_IN, 'true')})) GROUP BY ALL)
    WHERE a_rows <> b_rows
    """,
)
def months_compared(spark, sf_dir):
    """Two of all months differ: the others are summed up, not shuffled."""
    month = F.substring("day", 1, 7)
    old, new = lines(spark, sf_dir).withColumn("month", month), lines(spark, sf_dir, CHANGED_IN).withColumn("month", month)
    return multiset_compare(old, new, by="month")


@query(
    "differing_columns",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", uneven_values FROM (SELECT count(*) AS uneven_values FROM (
            SELECT {c} FROM (SELECT {c}, 1 AS w FROM ({lines_sql('l_returnflag', 'true')})
                UNION ALL SELECT {c}, -1 FROM ({lines_sql(CHANGED, 'true')}))
            GROUP BY {c} HAVING sum(w) <> 0)) WHERE uneven_values > 0"""
        for c in LINE_COLS
    ),
)
def columns_compared(spark, sf_dir):
    return differing_columns(lines(spark, sf_dir), lines(spark, sf_dir, CHANGED))


@query(
    "same_columns",
    " UNION ALL ".join(
        f"""SELECT l_linenumber, '{c}' AS "column", count(*) FILTER (WHERE w <> 0) = 0 AS same FROM (
            SELECT l_linenumber, {c}, sum(w) AS w FROM (SELECT l_linenumber, {c}, 1 AS w FROM ({lines_sql('l_returnflag', 'true')})
                UNION ALL SELECT l_linenumber, {c}, -1 FROM ({lines_sql(CHANGED, 'true')})) GROUP BY ALL) GROUP BY l_linenumber"""
        for c in LINE_COLS if c != "l_linenumber"
    ),
)
def columns_alike(spark, sf_dir):
    return same_columns(lines(spark, sf_dir), lines(spark, sf_dir, CHANGED), "l_linenumber")


@query(
    "group_diff",
    f"""
    SELECT coalesce(a.flag, b.flag) AS flag, coalesce(a.n, 0) AS rows, coalesce(a.u, 0) AS units,
           coalesce(b.n, 0) AS rows_b, coalesce(b.u, 0) AS units_b
    FROM (SELECT l_returnflag AS flag, count(*) AS n, CAST(sum(l_linenumber) AS bigint) AS u FROM lineitem GROUP BY 1) a
    FULL JOIN (SELECT {CHANGED} AS flag, count(*) AS n, CAST(sum(l_linenumber) AS bigint) AS u FROM lineitem GROUP BY 1) b
    ON a.flag = b.flag
    """,
)
def groups_compared(spark, sf_dir):
    return group_diff(lines(spark, sf_dir), lines(spark, sf_dir, CHANGED), "flag", "l_linenumber")


GUARD_DAY = dt.date(2001, 1, 31)
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
IN_SEGMENTS = "(" + ", ".join(f"'{s}'" for s in SEGMENTS) + ")"
COUNTED = f"""(upper("Order Status") = 'DELIVERED'
    OR (upper("Order Status") = 'DISPATCHED' AND {spark_sale_day()} <= DATE '{GUARD_DAY}' - 14))"""
STRICT = "upper(\"Type of Item\") IN ('ACTIVITY', 'REGULER')"


@query(
    "units_guard",
    f"""
    WITH m AS (SELECT *, {spark_sale_day()} AS day FROM {MARKET_FACTS.sql} WHERE {COUNTED} AND {STRICT}),
    e AS (SELECT strftime(day, '%Y-%m') AS ym, CAST(sum("Ordered Quantity") AS bigint) AS expected FROM m
          WHERE split_part(upper("Marketplace"), '_', -1) IN {IN_SEGMENTS} GROUP BY 1),
    a AS (SELECT strftime(day, '%Y-%m') AS ym,
                 CAST(sum("Ordered Quantity" * CASE WHEN strftime(day, '%Y-%m') = '1998-03' THEN 3 ELSE 1 END) AS bigint)
                 AS actual FROM m
          WHERE strpos("Marketplace", '_') > 0
            AND upper(substr("Marketplace", strpos("Marketplace", '_') + 1)) IN {IN_SEGMENTS} GROUP BY 1),
    j AS (SELECT coalesce(e.ym, a.ym) AS ym, coalesce(expected, 0) AS expected, coalesce(actual, 0) AS actual
          FROM e FULL JOIN a ON e.ym = a.ym)
    SELECT ym, expected, actual, actual - expected AS diff, (actual - expected) / greatest(expected, 1) * 100 AS pct,
           abs(actual - expected) > 50 AND abs(actual - expected) > greatest(expected, 1) * 0.25::double AS bad
    FROM j WHERE ym >= '1996-01'
    """,
)
def guard(spark, sf_dir):
    """Recounted units against a published history in which one month was tripled."""
    orders = MARKET_FACTS.df(spark, sf_dir)
    day = sale_day("SentOn", "CreatedOn")
    known = sales_type("Marketplace").isin(SEGMENTS)
    published = orders.filter(
        counted(F.upper("Order Status"), day, GUARD_DAY)
        & type_filter(F.upper("Type of Item"), keep_null=False)
    ).select(
        day.alias("SentOn"),
        (named("Ordered Quantity") * F.when(month_key(day) == "1998-03", 3).otherwise(1)).alias("Quantity"),
        F.lit("MARKET").alias("ReportSource"),
        F.when(known, F.lit(ECOMMERCE_CHANNEL)).otherwise(F.lit("OTHER")).alias("Channel"),
    )
    return units_guard(
        expected_units(orders, GUARD_DAY, SEGMENTS), published_units(published, "MARKET"), "1996-01", 0.25, 50
    )


NEW_MONTH = "strftime(\"SentOn\", '%Y-%m') = '1998-07' AND NOT (\"ReportSource\" = 'ERP' AND CAST(\"NoPesanan\" AS bigint) % 7 = 0)"


@query(
    "release_compare",
    f"""
    WITH h AS {HISTORY.sql},
    n AS (SELECT "ReportSource" AS s, count(*) AS rows, {SUMS} FROM h WHERE {NEW_MONTH} GROUP BY 1),
    o AS (SELECT "ReportSource" AS s, count(*) AS rows, {SUMS} FROM h
          WHERE strftime("SentOn", '%Y-%m') = '1998-07' GROUP BY 1)
    SELECT s AS "ReportSource", coalesce(n.rows, 0) AS rows, {', '.join(f'coalesce(n."{m}", 0) AS "{m}"' for m in METRICS)},
           coalesce(o.rows, 0) AS rows_old, {', '.join(f'coalesce(o."{m}", 0) AS "{m}_old"' for m in METRICS)},
           CASE WHEN n.rows = o.rows AND {' AND '.join(f'n."{m}" = o."{m}"' for m in METRICS)} THEN 'MATCH' ELSE 'DIFF' END
           AS status
    FROM n FULL JOIN o USING (s)
    """,
)
def releases_compared(spark, sf_dir):
    history = HISTORY.df(spark, sf_dir)
    lost = (named("ReportSource") == "ERP") & (named("NoPesanan").cast("bigint") % 7 == 0)
    return release_compare(history.filter((month_key("SentOn") == "1998-07") & ~lost), history)


CUT = "\"SentOn\" < DATE '2001-06-01' AND CAST(\"NoPesanan\" AS bigint) % 9 <> 0"


@query(
    "promotion_check",
    f"""
    WITH h AS {HISTORY.sql},
    f AS (SELECT count(*) FILTER (WHERE {CUT}) AS n, count(*) AS o,
                 max("SentOn") FILTER (WHERE {CUT}) AS nd, max("SentOn") AS od FROM h)
    SELECT 'unexpected' AS rule, 'Note' AS detail UNION ALL SELECT 'dropped', 'Variant'
    UNION ALL SELECT 'rows', CAST(n AS varchar) FROM f WHERE n < o * 0.95
    UNION ALL SELECT 'newest', CAST(nd AS varchar) FROM f WHERE nd < od
    """,
)
def promotion(spark, sf_dir):
    """A new release that lost rows, days and a column, and gained two, one of them allowed."""
    old = HISTORY.df(spark, sf_dir)
    new = old.filter(
        (named("SentOn") < F.lit(dt.date(2001, 6, 1))) & (named("NoPesanan").cast("bigint") % 9 != 0)
    ).drop("Variant").withColumns({"Note": F.lit(""), "Dispatch Date": named("SentOn")})
    return promotion_check(new, old, allowed=["Dispatch Date"])


@query(
    "promotion_check_footers",
    f"""
    WITH h AS {HISTORY.sql},
    f AS (SELECT count(*) FILTER (WHERE {CUT}) AS n, count(*) AS o,
                 max("SentOn") FILTER (WHERE {CUT}) AS nd, max("SentOn") AS od FROM h)
    SELECT 'unexpected' AS rule, 'Note' AS detail UNION ALL SELECT 'dropped', 'Variant'
    UNION ALL SELECT 'rows', CAST(n AS varchar) FROM f WHERE n < o * 0.95
    UNION ALL SELECT 'newest', CAST(nd AS varchar) FROM f WHERE nd < od
    """,
)
def promotion_by_footers(spark, sf_dir):
    """The same releases as files: rows and newest days out of the footers."""
    new_path, old_path = [new_folder(spark, name) for name in ("new-release", "old-release")]
    HISTORY.df(spark, sf_dir).write.parquet(old_path)
    old = spark.read.parquet(old_path)  # joined once
    new = old.filter(
        (named("SentOn") < F.lit(dt.date(2001, 6, 1))) & (named("NoPesanan").cast("bigint") % 9 != 0)
    ).drop("Variant").withColumns({"Note": F.lit(""), "Dispatch Date": named("SentOn")})
    new.write.parquet(new_path)
    return promotion_check_files(spark, new_path, old_path, allowed=["Dispatch Date"])


FIGURE_MONTHS = "strftime(\"SentOn\", '%Y-%m') IN ('1998-06', '1998-07', '1998-08')"
REBUILT = "CASE WHEN strftime(\"SentOn\", '%Y-%m') = '1998-07' AND \"ReportSource\" = 'ERP' THEN 2 ELSE 1 END"


@query(
    "stored_figures",
    f"""
    WITH h AS (SELECT *, strftime("SentOn", '%Y-%m') AS sale_month FROM {HISTORY.sql} WHERE {FIGURE_MONTHS}),
    v AS (SELECT sale_month, "ReportSource", count(*) AS rows, CAST(sum("Quantity" * {REBUILT}) AS bigint) AS "Quantity",
                 CAST(sum("Qty Sales") AS bigint) AS "Qty Sales", CAST(sum("Revenue") AS bigint) AS "Revenue",
                 CAST(sum("Qty Return") AS bigint) AS "Qty Return", CAST(sum("Quantity") AS bigint) AS "Quantity_old" FROM h GROUP BY ALL)
    SELECT *, rows AS rows_old, "Qty Sales" AS "Qty Sales_old", "Revenue" AS "Revenue_old", "Qty Return" AS "Qty Return_old",
           CASE WHEN "Quantity" = "Quantity_old" THEN 'MATCH' ELSE 'DIFF' END AS status FROM v
    """,
)
def figures_of_versions(spark, sf_dir):
    """Three months published, one rebuilt with other units: both versions compared by their stored figures."""
    path, month = new_folder(spark, "release"), month_key("SentOn")
    rows = HISTORY.df(spark, sf_dir).withColumn("sale_month", month).filter(F.col("sale_month").isin("1998-06", "1998-07", "1998-08"))
    doubled = F.when(named("ReportSource") == "ERP", 2).otherwise(1)
    rebuilt = rows.filter(F.col("sale_month") == "1998-07").withColumn("Quantity", named("Quantity") * doubled)
    for build in (rows, rebuilt):
        history = write_months_aside(build, path, "history", "sale_month")
        figures = write_months_aside(month_figures(read_aside(spark, path, history)), path, FIGURES, "sale_month")
        publish(spark, path, history, figures)
    return version_compare(stored_figures(spark, path), stored_figures(spark, path, 1))


@query(
    "stored_guard",
    f"""
    WITH h AS (SELECT strftime("SentOn", '%Y-%m') AS ym, * FROM {HISTORY.sql} WHERE "ReportSource" = 'MARKET'),
    a AS (SELECT ym, CAST(sum("Quantity") AS bigint) AS actual FROM h WHERE "Channel" = 'E-COMMERCE' GROUP BY 1),
    e AS (SELECT ym, CAST(sum("Quantity") AS bigint) AS expected FROM h GROUP BY 1)
    SELECT ym, expected, coalesce(actual, 0) AS actual, coalesce(actual, 0) - expected AS diff,
           (coalesce(actual, 0) - expected) / greatest(expected, 1) * 100 AS pct,
           abs(coalesce(actual, 0) - expected) > 50 AND abs(coalesce(actual, 0) - expected) > greatest(expected, 1) * 0.2::double AS bad
    FROM e LEFT JOIN a USING (ym)
    """,
)
def guard_by_figures(spark, sf_dir):
    """Units of all channels against those of one, both out of the stored figures of every month."""
    path = new_folder(spark, "release")
    rows = HISTORY.df(spark, sf_dir).withColumn("sale_month", month_key("SentOn"))
    publish(spark, path, write_months_aside(month_figures(rows), path, FIGURES, "sale_month"))
    figures = stored_figures(spark, path)
    market = figures.filter(named("ReportSource") == "MARKET")
    expected = market.groupBy(F.col("sale_month").alias("ym")).agg(F.sum("Quantity").alias("expected"))
    return units_guard(expected, stored_units(figures, "MARKET"), "1990-01", 0.2, 50)


REDELIVERED = "\"Source\" LIKE '98 03%' AND CAST(\"Order Number\" AS bigint) % 4 = 0"
COUNT_COLS = ["Source", "Order Number", "Item Name", "Ordered Quantity", "CreatedOn", "SentOn"]


def counted_sql(rows: str, as_of: dt.date) -> str:
    return f"""SELECT strftime({spark_sale_day()}, '%Y-%m') AS ym, {', '.join(f'"{c}"' for c in COUNT_COLS)} FROM ({rows})
        WHERE trim("Order Status") = 'DELIVERED' OR (trim("Order Status") = 'DISPATCHED' AND {spark_sale_day()} <= DATE '{as_of}' - 14)"""


LATER = AS_OF + dt.timedelta(days=40)
NEW_ORDERS_SQL = f"""SELECT * REPLACE (CASE WHEN {REDELIVERED} THEN '7' ELSE "Ordered Quantity" END AS "Ordered Quantity") FROM {MARKET_ORDERS.sql}
    WHERE "Source" NOT LIKE '97 11%(2)%'"""


@query(
    "months_to_rebuild",
    f"""
    SELECT DISTINCT ym FROM (
        SELECT ym, {', '.join(f'"{c}"' for c in COUNT_COLS)} FROM (
            SELECT *, 1 AS w FROM ({counted_sql(f'SELECT * FROM {MARKET_ORDERS.sql}', AS_OF)})
            UNION ALL SELECT *, -1 FROM ({counted_sql(NEW_ORDERS_SQL, LATER)}))
        GROUP BY ALL HAVING sum(w) <> 0)
    WHERE ym IS NOT NULL
    """,
)
def rebuilt_months(spark, sf_dir):
    """Forty days later, with some source files delivered anew and one taken back."""
    old = MARKET_ORDERS.df(spark, sf_dir)
    anew = named("Source").like("98 03%") & (named("Order Number").cast("bigint") % 4 == 0)
    quantity = F.when(anew, F.lit("7")).otherwise(named("Ordered Quantity"))
    new = old.withColumn("Ordered Quantity", quantity).filter(~named("Source").like("97 11%(2)%"))
    return touched_months(old, new, AS_OF, LATER, COUNT_COLS)


BOOK = "concat(cast(1 + o_custkey % 12 as string), '. Area Sell Through.xlsx')"


@query(
    "compile_check",
    f"""
    WITH o AS (SELECT {BOOK} AS f, o_custkey % 12 AS k, o_orderkey FROM orders)
    SELECT 'file missing' AS rule, f AS detail FROM (SELECT DISTINCT f FROM o WHERE k = 3)
    UNION ALL SELECT 'file new', f FROM (SELECT DISTINCT f FROM o WHERE k = 5)
    UNION ALL SELECT 'columns', 'SourceFile,Total,Date'
    UNION ALL SELECT 'rows', CAST(count(*) FILTER (WHERE k <> 3 AND o_orderkey % 5 <> 0) AS varchar) FROM o
        HAVING count(*) FILTER (WHERE k <> 3 AND o_orderkey % 5 <> 0) < count(*) FILTER (WHERE k <> 5) * 0.9
    UNION ALL SELECT 'dates', CAST(count(*) FILTER (WHERE k <> 3 AND o_orderkey % 5 <> 0 AND o_orderkey % 10 <> 1) AS varchar)
        FROM o HAVING count(*) FILTER (WHERE k <> 3 AND o_orderkey % 5 <> 0 AND o_orderkey % 10 <> 1)
            < count(*) FILTER (WHERE k <> 3 AND o_orderkey % 5 <> 0) * 0.95
    """,
)
def compiled_check(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.expr(BOOK).alias("SourceFile"),
        F.expr("case when o_orderkey % 10 = 1 then '' else cast(cast(o_orderdate as date) as string) end").alias("Date"),
        F.col("o_totalprice").alias("Total"), "o_custkey", "o_orderkey",
    )
    old = rows.filter("o_custkey % 12 <> 5").select("SourceFile", "Date", "Total")
    new = rows.filter("o_custkey % 12 <> 3 AND o_orderkey % 5 <> 0").select("SourceFile", "Total", "Date")
    return compile_check(new, old)


NOW = dt.datetime(2024, 1, 31)
LIMITS = {
    "click": dt.timedelta(minutes=30), "view": dt.timedelta(minutes=33), "purchase": dt.timedelta(minutes=36),
    "signup": dt.timedelta(minutes=60), "refund": dt.timedelta(minutes=60),
}
LAST_OUTPUT = dt.datetime(2024, 1, 30, 23, 28)
FRESH_SQL = f"""(
    SELECT dataset, max(ts) AS newest, any_value(age) AS age
    FROM (VALUES {', '.join(f"('{k}', {int(v.total_seconds())})" for k, v in LIMITS.items())}) l(dataset, age)
    LEFT JOIN events ON event_type = dataset GROUP BY dataset)"""


def fresh(spark, sf_dir):
    return freshness(table(spark, sf_dir, "events"), LIMITS, NOW, LAST_OUTPUT, "event_type", "ts")


@query(
    "freshness",
    f"""
    SELECT dataset, strftime(newest, '%Y-%m-%d %H:%M:%S.%f') AS newest,
           date_sub('second', newest, TIMESTAMP '{NOW}') AS age_seconds,
           coalesce(newest + to_seconds(age) < TIMESTAMP '{NOW}', true) AS stale,
           coalesce(newest > TIMESTAMP '{LAST_OUTPUT}', false) AS newer
    FROM {FRESH_SQL}
    """,
)
def freshness_query(spark, sf_dir):
    return fresh(spark, sf_dir).withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(
    "build_decision",
    f"""
    WITH s AS (SELECT string_agg(dataset, ', ' ORDER BY dataset) FILTER (
                   WHERE coalesce(newest + to_seconds(age) < TIMESTAMP '{NOW}', true)) AS stale,
                   bool_or(newest > TIMESTAMP '{LAST_OUTPUT}') AS newer FROM {FRESH_SQL})
    SELECT stale IS NULL AND newer AS run, CASE WHEN stale IS NOT NULL THEN 'wait: stale ' || stale
        WHEN NOT newer THEN 'skip: nothing new'
        ELSE 'ready: something new and nothing stale' END AS reason FROM s
    """,
)
def decision(spark, sf_dir):
    return build_decision(fresh(spark, sf_dir), NOW, LAST_OUTPUT, "click", rebuild_gap=dt.timedelta(0))


@query(
    "forced_decision",
    "SELECT count(*) >= 0 AS run, 'ready: forced' AS reason FROM events",
)
def forced_decision(spark, sf_dir):
    return build_decision(fresh(spark, sf_dir), NOW, LAST_OUTPUT, "click", force=True)


@query(
    "first_release",
    """
    SELECT 'dates' AS rule, CAST(count(*) FILTER (WHERE o_orderkey % 10 <> 1) AS varchar) AS detail FROM orders
    HAVING count(*) FILTER (WHERE o_orderkey % 10 <> 1) < count(*) * 0.95
    """,
)
def first_release(spark, sf_dir):
    """Tables without a published one: only the share of dates can hold them back."""
    rows = table(spark, sf_dir, "orders").select(
        F.expr(BOOK).alias("SourceFile"),
        F.expr("case when o_orderkey % 10 = 1 then '' else cast(cast(o_orderdate as date) as string) end").alias("Date"),
        F.col("o_totalprice").alias("Total"),
    )
    return compile_check(rows, None).unionByName(promotion_check(HISTORY.df(spark, sf_dir), None))
