"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.session import shared_dir, ship_package

#: Word pattern of the prose operators: anything but ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
#: Serialised size up to which a side table may be broadcast; past it the
#: operators shuffle instead.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the cluster's shared folder (cuts the lineage).

    Lost executors cost a re-read of the files, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark, 'llm')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def bounded(side: DataFrame, row_bytes: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``side`` with a broadcast hint if its measured size is within ``limit``.

    ``side`` must be cheap to read (a written table).  Beyond the limit it is
    returned as it is and the join shuffles.
    """
    size = side.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(side) if size <= limit else side


def row_key(text: Column) -> Column:
    """With doc_id this tells rows apart, up to rows that get equal results."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def join_rows(docs: DataFrame, side: DataFrame, how: str, row_bytes: Column | None = None) -> DataFrame:
    """docs joined with the written table ``side`` on (doc_id, row_key of the text).

    Other columns of docs may have any names; further columns of ``side`` keep
    theirs.  ``side`` is broadcast if its measured size allows, else shuffled.
    """
    d, k = (fresh(docs, n) for n in ("doc", "row"))
    side = side.withColumnsRenamed({"doc_id": d, "row_key": k})
    sized = bounded(side, F.lit(32) if row_bytes is None else row_bytes)
    out = docs.join(sized, docs["doc_id"].eqNullSafe(F.col(d)) & (row_key(docs["text"]) == F.col(k)), how)
    return out.drop(d, k)


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name
