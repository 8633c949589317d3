"""Versioned months: replaced together or not at all, pinned, emptied, cleaned up."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesflow.sources import releases
from salesflow.sources.releases import (
    VersionTaken, drop_versions, manifest, publish, read_months, versions, write_months_aside,
)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "store")


@pytest.fixture
def months(spark):
    return spark.sql("SELECT * FROM VALUES ('2026-08', 'a', 1), ('2026-08', 'b', 2), ('2026-09', 'c', 3) AS t(sale_month, no, n)")


def test_only_given_months_change(spark, path, months):
    assert publish(spark, path, write_months_aside(months, path, "history", "sale_month")) == 1
    again = months.filter("sale_month = '2026-09'").withColumn("n", F.lit(30))
    assert publish(spark, path, write_months_aside(again, path, "history", "sale_month")) == 2
    now = read_months(spark, path, "history").select("sale_month", "no", "n")
    assert rows(now) == Counter([("2026-08", "a", 1), ("2026-08", "b", 2), ("2026-09", "c", 30)])
    before = read_months(spark, path, "history", version=1).select("sale_month", "no", "n")
    assert rows(before) == rows(months)
    assert versions(spark, path) == [1, 2]


def test_a_run_that_dies_leaves_all_tables_as_they_were(spark, path, months):
    first = [write_months_aside(months, path, t, "sale_month") for t in ("report", "history")]
    publish(spark, path, *first)
    write_months_aside(months.withColumn("n", F.lit(0)), path, "report", "sale_month")  # and no more
    for table in ("report", "history"):
        assert rows(read_months(spark, path, table).select("sale_month", "no", "n")) == rows(months)


def test_a_failing_swap_leaves_the_old_version(spark, path, months, monkeypatch):
    publish(spark, path, write_months_aside(months, path, "history", "sale_month"))
    made = write_months_aside(months.filter("no = 'a'"), path, "history", "sale_month")
    real = releases._files

    def dies(session, at):
        if ".draft-" in at:
            raise OSError("killed")
        return real(session, at)

    monkeypatch.setattr(releases, "_files", dies)
    with pytest.raises(OSError):
        publish(spark, path, made)
    monkeypatch.undo()
    assert versions(spark, path) == [1]
    assert rows(read_months(spark, path, "history").select("sale_month", "no", "n")) == rows(months)


def test_the_second_of_two_runs_from_one_version_fails(spark, path, months):
    publish(spark, path, write_months_aside(months, path, "history", "sale_month"))
    one, two = (write_months_aside(months.withColumn("n", F.lit(n)), path, "history", "sale_month") for n in (10, 20))
    assert publish(spark, path, one, base=1) == 2
    with pytest.raises(VersionTaken):
        publish(spark, path, two, base=1)
    assert {r["n"] for r in read_months(spark, path, "history").collect()} == {10}


def test_a_reader_is_not_disturbed(spark, path, months):
    publish(spark, path, write_months_aside(months, path, "history", "sale_month"))
    reader = read_months(spark, path, "history")
    publish(spark, path, write_months_aside(months.withColumn("n", F.lit(0)), path, "history", "sale_month"))
    assert rows(reader.select("sale_month", "no", "n")) == rows(months)


def test_emptied_months_are_entries_without_files(spark, path, months):
    publish(spark, path, write_months_aside(months, path, "history", "sale_month"))
    left = months.filter("sale_month = '2026-08'")
    publish(spark, path, write_months_aside(left, path, "history", "sale_month", ["2026-08", "2026-09"]))
    assert manifest(spark, path)["history"].months["2026-09"].folder is None
    assert {r["sale_month"] for r in read_months(spark, path, "history").collect()} == {"2026-08"}
    none = months.filter("no = ''")
    publish(spark, path, write_months_aside(none, path, "history", "sale_month", ["2026-08"]))
    assert read_months(spark, path, "history").count() == 0


def test_months_with_other_columns_stack(spark, path, months):
    publish(spark, path, write_months_aside(months, path, "history", "sale_month"))
    other = spark.sql("SELECT '2026-10' AS sale_month, 'd' AS no, 'x' AS extra, '2026-10-02' AS day")
    publish(spark, path, write_months_aside(other, path, "history", "sale_month"))
    out = read_months(spark, path, "history", date_cols=["day"])
    assert rows(out.select("no", "n", "extra")) == Counter([("a", 1, None), ("b", 2, None), ("c", 3, None), ("d", None, "x")])
    assert dict(out.dtypes)["day"] == "date"


def test_reading_some_months_opens_only_their_folders(spark, path, months):
    publish(spark, path, write_months_aside(months, path, "history", "sale_month"))
    some = read_months(spark, path, "history", months=["2026-09"])
    assert len(some.inputFiles()) == 1 and rows(some.select("no")) == Counter([("c",)])
    pruned = read_months(spark, path, "history").filter("sale_month = '2026-09'")
    assert "PartitionFilters: [isnotnull(sale_month" in pruned._jdf.queryExecution().executedPlan().toString()


def test_old_versions_and_leftovers_go(spark, path, months):
    for n in range(4):
        publish(spark, path, write_months_aside(months.withColumn("n", F.lit(n)), path, "history", "sale_month"))
    write_months_aside(months, path, "history", "sale_month")  # of a run that died
    assert drop_versions(spark, path, keep=2) == [1, 2]
    assert versions(spark, path) == [3, 4]
    assert len(releases._found(spark, f"{path}/data/*/*/run=*")) == 4
    assert {r["n"] for r in read_months(spark, path, "history", 3).collect()} == {2}


def test_odd_month_names_and_unknown_tables(spark, path):
    odd = spark.sql("SELECT * FROM VALUES ('2026 09: Sep/x', 1), (null, 2) AS t(sale_month, n)")
    publish(spark, path, write_months_aside(odd, path, "t", "sale_month"))
    assert rows(read_months(spark, path, "t").select("sale_month", "n")) == rows(odd)
    with pytest.raises(ValueError, match="no table"):
        read_months(spark, path, "u")
