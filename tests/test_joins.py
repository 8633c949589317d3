"""Lookups: null matching, fan-out, and the same rows whichever way a master travels."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesflow import session
from salesflow.operators import joins
from salesflow.operators.joins import fits_broadcast, hot_keys, lookup, lookup_or_default
from salesflow.operators.masters import (
    area_master, keep_first, lookup_fanout, place_master, postcode_master, product_master, product_master_upper,
    standardise_places, unmatched_places,
)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def facts(spark):
    """A third of the rows hold one key, another part holds null."""
    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 1000).cast("int").alias("k"),
        (F.col("id") % 2).cast("string").alias("k2"),
    )


@pytest.fixture
def master(spark):
    data = [(k, str(j), f"name {k} {j}") for k in [*range(300), None] for j in (0, 1)] + [(7, "0", "again")]
    return spark.createDataFrame(data, "k long, k2 string, name string")


def brute(facts, master, keys, how="left"):
    """The nested loop the lookup must agree with; None equals None in Python as in the rule."""
    out = Counter()
    right = [r.asDict() for r in master.collect()]
    for left in (r.asDict() for r in facts.collect()):
        hits = [r for r in right if all(r[k] == left[k] for k in keys)]
        for r in hits or ([{"name": None}] if how == "left" else []):
            out[(*left.values(), r["name"])] += 1
    return out


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [10_000_000, 2000, -1])
def test_lookup_agrees_with_brute_force_on_every_path(facts, master, broadcast_below, limit, how):
    broadcast_below(limit)
    expected = brute(facts, master, ["k", "k2"], how)
    assert rows(lookup(facts, master, ["k", "k2"], how).select("id", "k", "k2", "name")) == expected


def test_oversize_master_splits_off_the_hot_keys(facts, master, broadcast_below):
    one = master.filter("k2 = '0' AND name <> 'again'").drop("k2")
    broadcast_below(1000)
    assert not fits_broadcast(one)
    assert len(hot_keys(facts, ["k"])) == 2
    plan = lookup(facts, one, ["k"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" in text
    assert rows(plan) == brute(facts, one, ["k"])


def test_rows_made_by_the_driver_are_measured(spark):
    assert fits_broadcast(spark.createDataFrame([(1, "a")], "k int, v string"))


def test_adaptive_execution_splits_null_safe_lookups(spark, facts, master, broadcast_below):
    """Facts behind a join: the hot and the null key are split when the join runs."""
    broadcast_below(-1)
    sizes = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    before = {key: spark.conf.get(key) for key in sizes}
    many = facts.join(spark.range(60_000).select((F.col("id") % 3000).alias("id"), F.uuid().alias("payload")), "id")
    one = master.filter("k2 = '0' AND name <> 'again'").drop("k2")
    try:
        for key, value in sizes.items():
            spark.conf.set(key, value)
        out = lookup(many, one, ["k"])
        assert len(out.collect()) == 60_000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_keys_of_other_types_still_meet(spark, facts, master, broadcast_below):
    """A double key equals a whole one but not as text, so such keys are not split off."""
    broadcast_below(1000)
    one = master.filter("k2 = '0' AND name <> 'again'").drop("k2")
    doubles = facts.withColumn("k", F.col("k").cast("double"))
    assert rows(lookup(doubles, one, ["k"])) == brute(doubles, one, ["k"])
    assert "BroadcastHashJoin" not in lookup(doubles, one, ["k"])._jdf.queryExecution().executedPlan().toString()


def test_no_hot_keys_no_split(spark):
    assert hot_keys(spark.range(5000).withColumnRenamed("id", "k"), ["k"]) == []


def test_facts_behind_a_join_are_not_read_for_hot_keys(facts, master):
    joined = facts.join(master.withColumnRenamed("k", "m"), F.expr("k = m"))
    assert hot_keys(joined, ["k"]) == []


def test_reduced_master_is_measured(spark, broadcast_below):
    big = spark.range(100_000).select((F.col("id") % 5).alias("k"), F.col("id").alias("row_no"), F.lit("x").alias("v"))
    small = keep_first(big, ["k"], ["row_no"])
    broadcast_below(2000)
    assert joins.planned_bytes(small) > 2000
    assert fits_broadcast(small)
    assert not fits_broadcast(big)


def test_plain_keys_do_not_match_null(spark):
    left = spark.sql("SELECT * FROM VALUES (1), (null) AS t(k)")
    right = spark.sql("SELECT * FROM VALUES (1, 'a'), (null, 'b') AS t(k, v)")
    assert rows(lookup(left, right, ["k"], nulls_match=False)) == Counter([(1, "a"), (None, None)])
    assert rows(lookup(left, right, ["k"])) == Counter([(1, "a"), (None, "b")])


def test_lookup_or_default_leaves_padding_alone(spark):
    left = spark.sql("SELECT * FROM VALUES ('1'), (' 1 '), ('  '), (null), ('9') AS t(code)")
    master = spark.sql("SELECT * FROM VALUES ('1', 'P', cast(null AS string)) AS t(`Kode Pos`, Province, City)")
    assert rows(lookup_or_default(left, master, "code", "Kode Pos")) == Counter(
        [("1", "P", "-"), (" 1 ", "-", "-"), ("-", "-", "-"), ("-", "-", "-"), ("9", "-", "-")]
    )


def test_keep_first_by_order_with_null_key(spark):
    df = spark.sql("SELECT * FROM VALUES (3, 'a', 'z'), (1, 'a', null), (2, null, 'x'), (5, null, 'y') AS t(n, k, v)")
    assert rows(keep_first(df, ["k"], ["n"])) == Counter([(1, "a", None), (2, None, "x")])


SHEET = "SELECT * FROM VALUES {} AS t(row_no, ItemName, Brand, Category, SubCategory, Variant, `Product Name`, `Type of Item`)"


def test_product_masters_treat_duplicates_differently(spark):
    sheet = spark.sql(SHEET.format("(1,'Tea','b','c','s','v','p','t'), (2,'tea','b2','c','s','v','p',null), (3,'Tea','b3','c','s','v','p','t')"))
    offline = product_master(sheet, ["row_no"])
    assert Counter(r["Brand"] for r in offline.collect()) == Counter(["b", "b2"])
    assert rows(lookup_fanout(offline, ["ItemName"])) == Counter([("TEA", 2)])
    cols = sheet.columns[1:]
    assert product_master_upper(sheet, cols).count() == 3
    assert "NAN" in {r["Type of Item"] for r in product_master_upper(sheet, cols, blank_as_text=True).collect()}


def test_area_and_postcode_masters(spark):
    areas = spark.sql("SELECT * FROM VALUES (1,'c','R0','0'), (2,'c','R1','A'), (3,'c','R2','A'), (4,'c','R3',null) AS t(row_no, City, Region, Province)")
    assert rows(area_master(areas, ["row_no"])) == Counter([("A", "R1"), (None, "R3")])
    codes = spark.sql("SELECT * FROM VALUES (1,' 10 ','P','C'), (2,'10','Q','D'), (3,' ','x','x'), (4,'nan','x','x'), (5,null,'x','x') AS t(row_no, `Kode Pos`, `Area Level 1`, `Area Level 2`)")
    assert rows(postcode_master(codes, ["row_no"])) == Counter([("10", "P", "C")])


def test_places(spark):
    sheet = spark.sql("SELECT * FROM VALUES (1,' A ','STD A','X'), (2,'A','other','Y'), (3,null,'BLANK','Z'), (4,'N',null,'W') AS t(row_no, City, S, D)")
    master = place_master(sheet, "City", "S", "D", ["row_no"])
    orders = spark.sql("SELECT * FROM VALUES ('P','A',1), ('P','A',1), (' P ','Q ',2), ('P',null,3), ('P','N',4), (null,'Q',5) AS t(Province, City, o)")
    assert rows(standardise_places(orders, master)) == Counter(
        [("P", "A", 1, "STD A", "X"), (" P ", "Q ", 2, "-", "-"), ("P", None, 3, "BLANK", "Z"), ("P", "N", 4, "-", "W"), (None, "Q", 5, "-", "-")]
    )
    assert [tuple(r) for r in unmatched_places(orders, master).collect()] == [("P", "N"), ("P", "Q"), (None, "Q")]


def test_estimates_that_are_too_low_are_not_trusted(spark, broadcast_below, tmp_path):
    broadcast_below(64 * 1024)
    grown = spark.range(4).select(F.explode(F.sequence(F.lit(1), F.lit(50_000))).alias("k"), F.lit("x").alias("v"))
    path = str(tmp_path / "long")
    spark.range(200).select(F.col("id").alias("k"), F.repeat(F.lit("text "), 400).alias("v"), F.lit(1).alias("w")).write.parquet(path)
    long = spark.read.parquet(path).select("k", "v")
    small = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    assert not fits_broadcast(grown)
    assert not fits_broadcast(long)
    assert fits_broadcast(small)
    facts = spark.range(1000).withColumnRenamed("id", "k")
    for master in (grown, long):
        assert "ResolvedHint" not in lookup(facts, master, ["k"])._jdf.queryExecution().analyzed().toString()


def jobs_of(spark, run):
    """How many jobs ``run`` starts, and its result."""
    group = f"probe-{id(run)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), out
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture
def wide_files(spark, tmp_path):
    path = str(tmp_path / "master")
    spark.range(20_000).select(F.col("id").alias("k"), F.uuid().alias("name")).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("limit", [10_000_000, 1000])
def test_plain_and_renamed_scans_start_no_job(spark, wide_files, broadcast_below, limit):
    broadcast_below(limit)
    renamed = wide_files.withColumnsRenamed({"k": "a", "name": "b"}).select("b", "a")
    for master in (wide_files, renamed):
        jobs, fits = jobs_of(spark, lambda m=master: fits_broadcast(m))
        assert jobs == 0 and fits == (limit > 1000)
    if limit > 1000:
        assert jobs_of(spark, lambda: lookup(spark.range(10).toDF("k"), wide_files, ["k"]))[0] == 0


def test_probe_ends_once_the_limit_is_passed(spark, broadcast_below):
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows_ = spark.range(0, 1_000_000, 1, 50).mapInArrow(counting, "id long")
    assert joins.passes(rows_, 4096 * 8 - 1)
    assert read.value < 200_000
    assert not joins.passes(spark.range(9000), 9000 * 8)
    assert joins.passes(spark.range(9000), 9000 * 8 - 1)
    assert not joins.passes(spark.range(0), 1)


def test_first_rows_that_are_wider_than_the_rest(spark):
    df = spark.range(0, 50_000, 1, 1).select(F.when(F.col("id") < 4096, F.repeat(F.lit("x"), 1000)).otherwise(F.lit("")).alias("v"))
    exact = 50_000 * 8 + 4096 * 1000
    assert not joins.passes(df, exact) and joins.passes(df, exact - 1)


@pytest.fixture
def many(spark, facts):
    """40 % of the rows under one key, behind a join."""
    more = facts.withColumn("k", F.when(F.col("id") % 5 < 2, F.lit(7)).otherwise(F.col("k")))
    other = spark.range(3000).select("id", F.concat(F.lit("p"), F.col("id")).alias("payload"))
    return more.join(other, "id")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("nulls_match", [True, False])
def test_salted_lookup_agrees_with_the_plain_join(many, master, broadcast_below, how, nulls_match):
    broadcast_below(-1)
    out = [lookup(many, master, ["k", "k2"], how, nulls_match, spread=way) for way in ("salted", "adaptive")]
    assert out[0].columns == out[1].columns
    assert rows(out[0]) == rows(out[1])
    assert "__salt" in out[0]._jdf.queryExecution().optimizedPlan().toString()


def test_salted_lookup_computes_the_facts_once_and_spreads_the_hot_key(spark, many, master, broadcast_below):
    broadcast_below(-1)
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    counted = many.select("id", "k", "k2").mapInArrow(counting, "id long, k int, k2 string")
    one = master.filter("k2 = '0' AND name <> 'again'").drop("k2")
    dealt = lookup(counted, one, ["k"], spread="salted")
    assert dealt.count() == 3000
    assert read.value == 3000
    salted = lookup(counted, one, ["k"], spread="salted")
    per_task = salted.repartition(1).groupBy("k").count()  # plan only: the join below carries the salt
    text = per_task._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in text and "__copy" in text


def test_auto_salts_only_what_adaptive_execution_cannot_split(spark, many, master, broadcast_below):
    broadcast_below(-1)
    one = master.filter("k2 = '0' AND name <> 'again'").drop("k2")
    shuffled = lookup(many, one, ["k"])
    assert "__salt" not in shuffled._jdf.queryExecution().optimizedPlan().toString()
    whole = many.withColumn("k", F.col("k").cast("long"))
    by_key = whole.join(spark.range(400).selectExpr("id AS k", "id + 1 AS other"), "k", "left")
    lying = lookup(by_key, one, ["k"], nulls_match=False)
    assert "__salt" in lying._jdf.queryExecution().optimizedPlan().toString()
    assert rows(lying) == rows(lookup(by_key, one, ["k"], nulls_match=False, spread="adaptive"))


def test_prepared_masters_are_written_once(spark, master, wide_files):
    computed = keep_first(master, ["k"], ["k2", "name"])
    assert joins.scan_bytes(computed) is None
    kept = joins.prepared(computed)
    assert joins.scan_bytes(kept) is not None and rows(kept) == rows(computed)
    assert joins.prepared(wide_files) is wide_files


def test_scratch_folders_go(spark, master):
    import os

    with session.scratch(spark):
        kept = joins.prepared(keep_first(master, ["k"], ["k2", "name"]))
        folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert kept.count() > 0 and os.path.isdir(folder)
    assert not os.path.exists(folder)
    assert os.path.isdir(joins.prepared(keep_first(master, ["k"], ["k2"])).inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0])


@pytest.mark.parametrize("nothing", ["false", "id < 0"])
def test_salted_lookup_of_no_facts(many, master, broadcast_below, nothing):
    broadcast_below(-1)
    none = many.filter(nothing)
    assert lookup(none, master, ["k", "k2"], spread="salted").count() == 0
    assert rows(lookup(many, master.filter("false"), ["k", "k2"], spread="salted").select("id")) == rows(many.select("id"))
