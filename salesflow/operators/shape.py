"""Column lists, renames, typing and unions by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
    LongType, NumericType, ShortType, StringType, StructField, StructType, TimestampNTZType,
    TimestampType, NullType,
)

from salesflow.functions import named
from salesflow.functions.dates import parse_date
from salesflow.functions.kinds import as_day, column_as, to_text
from salesflow.functions.numbers import coerce_int

WHOLE_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
WHOLE_KINDS = list(WHOLE_DIGITS)

INDEX_PREFIX = "__index_level_"


def require_columns(df: DataFrame, names: Iterable[str], hint: str = "") -> DataFrame:
    """Fail before any job starts when a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}. {hint}".strip())
    return df


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the schema's columns in its order: cast, add missing as null, drop the rest."""
    return df.select([_shaped(df, field) for field in schema.fields])


def _shaped(df: DataFrame, field: StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    have = df.schema[field.name].dataType
    if have == field.dataType:
        return named(field.name)
    if isinstance(field.dataType, StringType):
        return to_text(df, field.name).alias(field.name)
    return named(field.name).cast(field.dataType).alias(field.name)


def rename_drop(df: DataFrame, renames: Mapping[str, str], drops: Iterable[str] = ()) -> DataFrame:
    """Drop what is present, then rename."""
    return df.drop(*drops).withColumnsRenamed(dict(renames))


def move_after(df: DataFrame, name: str, anchor: str) -> DataFrame:
    """The same columns with one moved right behind another."""
    rest = [c for c in df.columns if c != name]
    at = rest.index(anchor) + 1
    return df.select([named(c) for c in rest[:at] + [name] + rest[at:]])


def typed(
    df: DataFrame, dates: Sequence[str], longs: Sequence[str], texts: Sequence[str]
) -> DataFrame:
    """Type a text table: dates or null, whole numbers or 0, texts or ''.

    Listed columns that are absent are added; columns not listed pass through unchanged.
    """
    absent = [n for n in [*dates, *longs, *texts] if n not in df.columns]
    out = df.withColumns({n: F.lit(None).cast("string") for n in absent}) if absent else df
    return out.withColumns(
        {
            **{n: column_as(out, n, as_day) for n in dates},
            **{n: coerce_int(n) for n in longs},
            **{n: F.coalesce(to_text(out, n), F.lit("")) for n in texts},
        }
    )


def supertype(a: DataType, b: DataType) -> DataType:
    """The type both sides widen to; text wins over everything else."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StringType) or isinstance(b, StringType):
        return StringType()
    for one, other in ((a, b), (b, a)):
        if isinstance(one, BooleanType) and isinstance(other, NumericType):
            return other
    if isinstance(a, NumericType) and isinstance(b, NumericType):
        return _wider_number(a, b)
    moments = (DateType, TimestampNTZType, TimestampType)
    if isinstance(a, moments) and isinstance(b, moments):
        return max((a, b), key=lambda t: moments.index(type(t)))
    raise TypeError(f"no common type for {a.simpleString()} and {b.simpleString()}")


def _wider_number(a: DataType, b: DataType) -> DataType:
    if type(a) in WHOLE_KINDS and type(b) in WHOLE_KINDS:
        return max((a, b), key=lambda t: WHOLE_KINDS.index(type(t)))
    a, b = (DecimalType(WHOLE_DIGITS[type(t)], 0) if type(t) in WHOLE_DIGITS and isinstance(o, DecimalType) else t for t, o in ((a, b), (b, a)))
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return DecimalType(min(38, whole + scale), scale)
    if isinstance(a, FloatType) and isinstance(b, FloatType):
        return FloatType()
    return DoubleType()


def common_schema(
    dfs: Sequence[DataFrame], meet: Callable[[DataType, DataType], DataType] = supertype
) -> StructType:
    """All columns in first-seen order, each with the type its inputs ``meet`` in."""
    fields = [field for df in dfs for field in df.schema.fields]
    names = dict.fromkeys(f.name for f in fields)
    return StructType([StructField(n, reduce(meet, [f.dataType for f in fields if f.name == n])) for n in names])


def first_real(a: DataType, b: DataType) -> DataType:
    """The first type that is more than blank."""
    return b if isinstance(a, NullType) else a


def union_relaxed(*dfs: DataFrame) -> DataFrame:
    """Stack by name; a missing column is null and differing types widen (text wins)."""
    schema = common_schema(dfs)
    return union_all([conform(df, schema) for df in dfs])


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack inputs that already share one schema."""
    return reduce(DataFrame.unionByName, dfs)


def stack_months(dfs: Sequence[DataFrame], date_cols: Sequence[str]) -> DataFrame:
    """Stack month units under one schema.

    Columns come in first-seen order. A column keeps the first real type it shows; one that
    is blank in every month becomes text; the named date columns become dates whatever a
    blank month stored; leftover index columns are dropped.
    """
    own = [df.drop(*[c for c in df.columns if c.startswith(INDEX_PREFIX)]) for df in dfs]

    def settled(field: StructField) -> StructField:
        blank = StringType() if isinstance(field.dataType, NullType) else field.dataType
        return StructField(field.name, DateType() if field.name in date_cols else blank)

    schema = StructType([settled(f) for f in common_schema(own, first_real).fields])
    return union_all([conform(_text_dates(df, date_cols), schema) for df in own])


def _text_dates(df: DataFrame, date_cols: Sequence[str]) -> DataFrame:
    texts = [
        n for n in date_cols if n in df.columns and isinstance(df.schema[n].dataType, StringType)
    ]
    return df.withColumns({n: parse_date(n) for n in texts}) if texts else df
