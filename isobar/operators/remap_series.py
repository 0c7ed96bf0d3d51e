"""Remapping of whole step series (J1) as a blocked sparse-matrix product.

In :func:`isobar.operators.remap.remap_apply` a weight meets its source once
per step.  Here it meets the source's whole step array once: sources travel as
one row per series, to the blocks of targets that need them, with the block's
weights.  A task holds one block of weights and the sources of one field in it,
and multiplies them with numpy for all steps at once.  The number of rows that
are shuffled does not depend on the number of steps.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import grid
from ..session import ship_package
from .joins import SMALL_SIDE_ROWS, bounded_broadcast
from .remap import MAX_BROADCAST_WEIGHTS, method_of

#: Side of a block of targets, in cells of the regular grid.
TILE = 32
LEAD = ["run", "param", "member"]


def tile_of(dst_id: Column) -> Column:
    """Block of a row-major target id of the regular grid."""
    iy, ix = F.floor(dst_id / grid.GRID_NX), F.pmod(dst_id, F.lit(grid.GRID_NX))
    wide = -(-grid.GRID_NX // TILE)
    return (F.floor(iy / TILE) * wide + F.floor(ix / TILE)).cast("long")


def native_series(native: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(series, axes): one row per source with its values along the step axis
    of its field (NaN where a step is absent), and the axis of every field."""
    axes = native.groupBy(*LEAD).agg(F.array_sort(F.collect_set("step")).alias("steps"))
    packed = native.groupBy(*LEAD, "src_id").agg(F.map_from_entries(F.collect_list(F.struct("step", F.col("value").cast("double")))).alias("at"))
    on_axis = F.transform("steps", lambda s: F.coalesce(F.try_element_at("at", s), F.lit(float("nan"))))
    # a row per field: its axis
    return packed.join(bounded_broadcast(axes, SMALL_SIDE_ROWS), LEAD).select(*LEAD, "src_id", on_axis.alias("vals")), axes


def weight_blocks(weights: DataFrame, block: Column | None = None) -> DataFrame:
    """(method, block, dst, src, vals): the weights of a block of targets in one row (once per grid pair)."""
    return (weights.withColumn("block", tile_of(F.col("dst_id")) if block is None else block)
            .groupBy("method", "block").agg(F.array_sort(F.collect_list(F.struct("dst_id", "src_id", "w"))).alias("e"))
            .select("method", "block", F.col("e.dst_id").alias("dst"), F.col("e.src_id").alias("src"), F.col("e.w").alias("vals")))


def routed(series: DataFrame, axes: DataFrame, blocks: DataFrame, methods: Mapping[str, str] | None = None,
           max_broadcast: int = MAX_BROADCAST_WEIGHTS) -> DataFrame:
    """What the blocks' tasks get: per run a block's weights (kind 0), per field its axis (1), and the sources it needs (2)."""
    def row(df: DataFrame, kind: int, **columns: Column) -> DataFrame:
        names = {"param": "string", "member": "int", "src_id": "long", "dst": "array<long>", "src": "array<long>",
                 "vals": "array<double>", "steps": "array<int>"}
        return df.select("run", "method", "block", F.lit(kind).alias("kind"),
                         *[columns.get(n, F.lit(None)).cast(t).alias(n) for n, t in names.items()])

    c = F.col
    of_method = method_of(c("param"), methods)
    fields = axes.withColumn("method", of_method)
    runs = bounded_broadcast(fields.select("run", "method").distinct(), SMALL_SIDE_ROWS)
    heads = row(blocks.join(runs, "method"), 0, dst=c("dst"), src=c("src"), vals=c("vals"))
    per_field = row(blocks.select("method", "block").join(bounded_broadcast(fields, SMALL_SIDE_ROWS), "method"), 1,
                    param=c("param"), member=c("member"), steps=c("steps"))
    needed = (blocks.select(c("method").alias("_m"), "block", F.explode(F.array_distinct("src")).alias("src_id")))
    met = series.withColumn("method", of_method).join(bounded_broadcast(needed, max_broadcast), "src_id").where(c("method") == c("_m"))
    sources = row(met, 2, param=c("param"), member=c("member"), src_id=c("src_id"), vals=c("vals"))
    return heads.unionByName(per_field).unionByName(sources)


class _Block:
    """The weights of one block, and the sources of the field that is being read."""

    def __init__(self, dst: np.ndarray, src: np.ndarray, w: np.ndarray):
        self.dst, self.first = np.unique(dst, return_index=True)  # entries come in the order of their targets
        self.src, self.at = np.unique(src, return_inverse=True)
        self.w = w[:, None]

    def open(self, steps: np.ndarray) -> None:
        self.steps = steps
        self.values = np.full((len(self.src), len(steps)), np.nan)

    def take(self, src: np.ndarray, values: np.ndarray) -> None:
        self.values[np.searchsorted(self.src, src)] = values

    def product(self, renormalize: bool) -> np.ndarray:
        x = self.values[self.at]
        if not renormalize:
            return np.add.reduceat(self.w * x, self.first, axis=0)
        ok = ~np.isnan(x)
        total = np.add.reduceat(np.where(ok, self.w * np.nan_to_num(x), 0.0), self.first, axis=0)
        weight = np.add.reduceat(np.where(ok, self.w, 0.0), self.first, axis=0)
        return np.where(weight != 0, total / np.where(weight != 0, weight, 1.0), np.nan)


def _flat(column: pa.Array, a: int, b: int) -> np.ndarray:
    return column.slice(a, b - a).flatten().to_numpy(zero_copy_only=False)


def remap_series(series: DataFrame, axes: DataFrame, blocks: DataFrame, methods: Mapping[str, str] | None = None,
                 na: str = "propagate", max_broadcast: int = MAX_BROADCAST_WEIGHTS) -> DataFrame:
    """J1 on the series layout: (run, param, member, dst_id, steps, vals), every target of every field.

    ``series`` and ``axes`` come from :func:`native_series`, ``blocks`` from
    :func:`weight_blocks`.  Results equal :func:`isobar.operators.remap.remap_apply`
    with the same ``na``.  Tasks take (run, block) units in the order of fields,
    so memory is one block's weights and one field's sources.
    """
    if na not in ("propagate", "renormalize"):
        raise ValueError("na must be 'propagate' or 'renormalize'")
    ship_package(series.sparkSession)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, field, block = None, None, None

        def close() -> Iterator[pa.RecordBatch]:
            if field is not None and len(block.steps):
                y = block.product(na == "renormalize").astype(np.float32)
                n, k = y.shape
                offsets = pa.array(np.arange(n + 1, dtype=np.int32) * k)
                yield pa.RecordBatch.from_pydict({
                    "run": pa.array([unit[0]] * n, pa.string()), "param": pa.array([field[0]] * n, pa.string()),
                    "member": pa.array([field[1]] * n, pa.int32()), "dst_id": pa.array(block.dst),
                    "steps": pa.ListArray.from_arrays(offsets, pa.array(np.tile(block.steps, n).astype(np.int32))),
                    "vals": pa.ListArray.from_arrays(offsets, pa.array(y.ravel()))})

        for batch in batches:
            run, method, param = (batch.column(c).dictionary_encode() for c in ("run", "method", "param"))
            kind, at = batch.column("kind").to_numpy(), batch.column("block").to_numpy()
            member = batch.column("member").fill_null(-1).to_numpy(zero_copy_only=False)
            codes = np.stack([run.indices.to_numpy(), method.indices.to_numpy(), at, kind,
                              param.indices.fill_null(-1).to_numpy(zero_copy_only=False), member])
            edge = np.r_[0, np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(axis=0)) + 1, batch.num_rows]
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if a == b:
                    continue
                if kind[a] == 0:
                    yield from close()
                    field = None
                    unit = (run[a].as_py(), method[a].as_py(), int(at[a]))
                    block = _Block(*(_flat(batch.column(c), a, a + 1) for c in ("dst", "src", "vals")))
                elif kind[a] == 1:
                    yield from close()
                    field = (param[a].as_py(), int(member[a]))
                    block.open(_flat(batch.column("steps"), a, a + 1))
                else:
                    values = _flat(batch.column("vals"), a, b).reshape(b - a, -1)
                    block.take(batch.column("src_id").slice(a, b - a).to_numpy(zero_copy_only=False), values)
        if unit is not None:
            yield from close()

    units = ["run", "method", "block"]
    rows = routed(series, axes, blocks, methods, max_broadcast).repartition(*units).sortWithinPartitions(
        *units, F.col("kind") > 0, "param", "member", "kind", "src_id")
    return rows.mapInArrow(multiply, "run string, param string, member int, dst_id long, steps array<int>, vals array<float>")
