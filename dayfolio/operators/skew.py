"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

BROADCAST_BYTES = 16 << 20


def value_bytes(value: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes in memory, from its type and the lengths of its parts."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + 16
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.aggregate(value, F.lit(16).cast("long"), lambda total, v: total + value_bytes(v, kind.elementType)), F.lit(8).cast("long"))
    if isinstance(kind, T.MapType):
        return value_bytes(F.map_keys(value), T.ArrayType(kind.keyType)) + value_bytes(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        return sum((value_bytes(value[f.name], f.dataType) for f in kind.fields), F.lit(8).cast("long"))
    return F.lit(16 if isinstance(kind, T.DecimalType) else 8).cast("long")


def is_small(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether the rows, whose bytes tasks add up, take no more than ``most``."""
    size = sum((value_bytes(df[f"`{f.name}`"], f.dataType) for f in df.schema.fields), F.lit(0).cast("long"))
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= most


def small_or_plain(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Marks a side for broadcast only after its bytes are known to be few."""
    return F.broadcast(df) if is_small(df, most) else df


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Adds the columns of a one-row table, such as a total, to every row."""
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one").drop("_one")


def salted_join(large: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left",
                salts: int = 16) -> DataFrame:
    """Joins a table that may have hot keys with one that has a row per key.

    Rows of the large side are spread over ``salts`` copies of the per-key row,
    so no task receives a whole hot key. The per-key side must be unique.
    """
    spread = large.withColumn("_salt", F.pmod(F.xxhash64(*large.columns), F.lit(salts)).cast("int"))
    copies = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*keys, "_salt"], how).drop("_salt")
