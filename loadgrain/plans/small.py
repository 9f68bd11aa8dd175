"""Size-checked small sides: broadcast what is proven small, shuffle what is not."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadgrain.plans.scratch import new_folder

# rows and bytes of a side that every task may hold
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def pin_small(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> tuple[DataFrame, int | None]:
    """Compute a table that is expected to be small, once.

    The table is computed into Spark's storage, where its rows and bytes are added up. Within both bounds it is fetched
    and comes back as a local table marked for broadcast, together with its row count. A larger one is
    not fetched: it is written to the shared folder and comes back from there, without a hint and with ``None`` for the
    count, so that the join using it shuffles.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, size = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0))).first()
        if n <= max_rows and size <= max_bytes:
            return F.broadcast(df.sparkSession.createDataFrame(kept.toArrow(), schema=df.schema)), n
        return stored(kept, "larger-side"), None
    finally:
        kept.unpersist()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table, written once to the shared folder and read from there."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row's values: texts, arrays and maps by their content, all else by type."""
    return reduce(lambda a, b: a + b, [_bytes(F.col(f"`{f.name}`"), f.dataType) for f in schema], F.lit(0).cast("bigint"))


def _bytes(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(value, F.lit(8).cast("bigint"), lambda total, x: total + _bytes(x, kind.elementType))
    elif isinstance(kind, T.MapType):
        size = _bytes(F.map_keys(value), T.ArrayType(kind.keyType)) + _bytes(F.map_values(value), T.ArrayType(kind.valueType))
    elif isinstance(kind, T.StructType):
        size = reduce(lambda a, b: a + b, [_bytes(value.getField(f.name), f.dataType) for f in kind], F.lit(0).cast("bigint"))
    else:
        return F.lit(16).cast("bigint")
    return F.coalesce(size, F.lit(0)).cast("bigint") + F.lit(8)
