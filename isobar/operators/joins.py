"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

SMALL_SIDE_ROWS = 1_000_000  # default bound for per-run / per-file / per-box tables
SMALL_SIDE_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """Approximate serialised bytes of a row: text, binary and array columns by
    their length, maps and structs as JSON text, everything else 8 bytes."""
    total = F.lit(16)
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (StringType, BinaryType)):
            n = F.octet_length(c)
        elif isinstance(t, ArrayType) and not isinstance(t.elementType, (StringType, ArrayType, StructType, MapType)):
            n = F.size(c) * 8
        elif isinstance(t, (ArrayType, StructType, MapType)):
            n = F.octet_length(F.to_json(c))
        else:
            n = F.lit(8)
        total = total + F.greatest(F.coalesce(n, F.lit(0)), F.lit(8))
    return total


def side_size(df: DataFrame) -> DataFrame:
    """Rows and bytes of ``df`` in one row: sums, combined before they are sent."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"))


def bounded_broadcast(df: DataFrame, max_rows: int, max_bytes: int = SMALL_SIDE_BYTES, reuse: bool = True) -> DataFrame:
    """``broadcast(df)`` when ``df`` keeps within ``max_rows`` and ``max_bytes``, else ``df``.

    With ``reuse`` the side is checkpointed first (in the cluster's shared
    folder), so its plan runs once however often it is measured and joined;
    pass ``False`` for a side that is a plain scan.  A larger side falls back
    to a shuffle join that AQE may still convert at runtime.
    """
    if reuse:
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint()
    size = side_size(df).first()
    return F.broadcast(df) if size["n"] <= max_rows and size["bytes"] <= max_bytes else df


#: Rows that one task groups: its groups' memory stays bounded however large the input is.
GROUPED_ROWS = 1_000_000


def dealt(df: DataFrame, n_rows: int, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` for a grouping by them, ``GROUPED_ROWS`` rows a task.

    Up to that many rows per core ``df`` is left to the grouping's own shuffle.
    """
    tasks = -(-n_rows // GROUPED_ROWS)
    return df.repartition(tasks, *keys) if tasks > df.sparkSession.sparkContext.defaultParallelism else df
