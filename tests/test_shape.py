import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, NullType, StringType, StructField, StructType,
    TimestampNTZType,
)

from salesflow.operators.compare import differing_columns, group_diff, multiset_compare, schema_diff, set_diff
from salesflow.operators.shape import (
    conform, move_after, rename_drop, require_columns, stack_months, supertype, typed, union_relaxed,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_supertype():
    s, i, n, d = StringType(), IntegerType(), LongType(), DoubleType()
    assert supertype(i, n) == n and supertype(n, d) == d and supertype(n, s) == s and supertype(DateType(), s) == s
    assert supertype(NullType(), i) == i and supertype(BooleanType(), i) == i
    assert supertype(DateType(), TimestampNTZType()) == TimestampNTZType()
    assert supertype(DecimalType(10, 2), DecimalType(8, 4)) == DecimalType(12, 4)
    with pytest.raises(TypeError):
        supertype(DateType(), i)


def test_union_lets_text_win_and_keeps_every_row(spark):
    a = spark.sql("SELECT 5000000000D AS n, date'2026-01-02' AS d")
    b = spark.sql("SELECT 'x' AS n, 1 AS extra")
    c = spark.sql("SELECT 7 AS n, 'later' AS d")
    out = union_relaxed(a, b, c)
    assert out.columns == ["n", "d", "extra"]
    assert rows(out) == rows(spark.sql("SELECT * FROM VALUES ('5000000000', '2026-01-02', null), ('x', null, 1), ('7', 'later', null)"))


def test_conform_orders_adds_and_drops(spark):
    schema = StructType([StructField("b", LongType()), StructField("c", StringType()), StructField("a", DateType())])
    out = conform(spark.sql("SELECT timestamp_ntz'2026-01-02 10:00:00' AS a, 3 AS b, 1 AS z"), schema)
    assert out.dtypes == [("b", "bigint"), ("c", "string"), ("a", "date")]
    assert rows(out) == [(3, None, dt.date(2026, 1, 2))]


def test_rename_drop_move_and_required(spark):
    df = spark.sql("SELECT 1 AS `DO Number`, 2 AS b, 3 AS c")
    assert rename_drop(df, {"DO Number": "NoPesanan", "nope": "x"}, ["c", "gone"]).columns == ["NoPesanan", "b"]
    assert move_after(df, "c", "DO Number").columns == ["DO Number", "c", "b"]
    with pytest.raises(ValueError, match="SentOn"):
        require_columns(df, ["b", "SentOn"])


def test_typed_fills_and_passes_through(spark):
    df = spark.sql("SELECT * FROM VALUES ('2026-01-02', '12.7', null, 'k'), ('x', null, 't', null) AS t(d, n, s, other)")
    out = typed(df, ["d", "d2"], ["n", "n2"], ["s", "s2"])
    assert rows(out.select("d", "d2", "n", "n2", "s", "s2", "other")) == rows(
        spark.sql("SELECT * FROM VALUES (date'2026-01-02', cast(null AS date), 12L, 0L, '', '', 'k'), (null, null, 0L, 0L, 't', '', null)")
    )


def test_stack_months_unifies(spark):
    blank = F.lit(None)
    a = spark.sql("SELECT 'r' AS s").select("s", blank.alias("q"), blank.alias("SentOn"), blank.alias("never"), F.lit(1).alias("__index_level_0__"))
    b = spark.sql("SELECT 5L AS q, timestamp_ntz'2026-01-02 00:00:00' AS SentOn, 'late' AS extra")
    c = spark.sql("SELECT 'z' AS s, '03/01/2026' AS SentOn")
    out = stack_months([a, b, c], ["SentOn"])
    assert out.dtypes == [("s", "string"), ("q", "bigint"), ("SentOn", "date"), ("never", "string"), ("extra", "string")]
    assert out.count() == 3
    assert {r["SentOn"] for r in out.collect()} == {None, dt.date(2026, 1, 2), dt.date(2026, 1, 3)}


def test_multiset_compare_counts_copies_and_ignores_order(spark):
    a = spark.range(2000).select((F.col("id") % 3).alias("x"), F.when(F.col("id") % 2 == 0, F.lit("t")).alias("y"))
    shuffled = a.orderBy(F.desc("x")).select("y", "x")
    assert multiset_compare(a, shuffled).count() == 0
    assert differing_columns(a, shuffled).count() == 0
    other = a.union(spark.sql("SELECT 0L, cast(null AS string)"))
    row = multiset_compare(a, other).first()
    assert (row["x"], row["y"], row["b_rows"] - row["a_rows"]) == ("0", None, 1)
    swapped = spark.sql("SELECT * FROM VALUES (1, 'b'), (2, 'a') AS t(x, y)")
    plain = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(x, y)")
    assert multiset_compare(plain, swapped).count() == 4 and differing_columns(plain, swapped).count() == 0


def test_set_and_group_and_schema_differences(spark):
    a = spark.sql("SELECT * FROM VALUES ('x', 1), ('y', 2), (null, 3), ('y', 4) AS t(k, q)")
    b = spark.sql("SELECT * FROM VALUES ('y', 2), ('z', 5) AS t(k, q)")
    assert rows(set_diff(a, b, "k")) == rows(spark.sql("SELECT * FROM VALUES ('x', 'missing'), ('z', 'new'), (null, 'missing')"))
    found = {r["k"]: (r["rows"], r["rows_b"]) for r in group_diff(a, b, "k", "q").collect()}
    assert found == {"x": (1, 0), "y": (2, 1), "z": (0, 1), None: (1, 0)}
    old, new = spark.sql("SELECT 1 AS a, 1 AS b, 1 AS c"), spark.sql("SELECT 1 AS c, 1 AS a, 1 AS d, 1 AS e")
    assert rows(schema_diff(old, new, ["d"])) == [
        ("added", "d"), ("dropped", "b"), ("moved", "a"), ("moved", "c"), ("unexpected", "e"),
    ]
