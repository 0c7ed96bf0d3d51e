"""Chunk stores as a Python Data Source: ``spark.read.format("isobar_chunks")``.

Reading plans its partitions from the groups' consolidated metadata: filters on
run, param, cy, cx, iy, ix and step are pushed, so chunks that cannot match are
not opened and steps that are not asked for are not built.  Writing takes the
rows of :func:`isobar.sources.chunks.chunk_rows`; chunk files are written by the
tasks, the groups' metadata by the commit, so a failed job leaves no group that
looks complete.
"""

from __future__ import annotations

import io
import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual,
                                    In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage)
from pyspark.sql.types import StructType

from ..session import ship_package
from . import chunks

NAME = "isobar_chunks"
#: Chunk files that one task reads.
PER_TASK = 16


def register(spark: SparkSession) -> None:
    """Make the format known to the session, with filters pushed to it."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    if not getattr(spark, "_isobar_chunks", False):
        spark.dataSource.register(ChunkSource)
        spark._isobar_chunks = True


def _true(options: dict, name: str) -> bool:
    return str(options.get(name, "false")).lower() == "true"


class ChunkSource(DataSource):
    """Options: path; ensemble (true: a member column); for writing chunk, level and listing."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        member = "member int, " if _true(self.options, "ensemble") else ""
        return f"run string, param string, {member}step int, iy int, ix int, value float, cy int, cx int"

    def reader(self, schema: StructType) -> ChunkReader:
        return ChunkReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> ChunkWriter:
        if overwrite:
            raise ValueError("chunk stores are written group by group; use mode('append')")
        return ChunkWriter(dict(self.options))


@dataclass
class Range:
    """Values that pushed filters leave of a column."""

    low: float = -math.inf
    high: float = math.inf
    only: frozenset | None = None

    def take(self, f: Filter) -> None:
        if isinstance(f, (EqualTo, In)):
            values = frozenset(f.value if isinstance(f, In) else [f.value])
            self.only = values if self.only is None else self.only & values
        elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            self.low = max(self.low, f.value + isinstance(f, GreaterThan))
        else:
            self.high = min(self.high, f.value - isinstance(f, LessThan))

    def may(self, first, last=None) -> bool:
        """Can a value from ``first`` to ``last`` be among them?"""
        last = first if last is None else last
        if self.only is not None and not any(first <= v <= last for v in self.only):
            return False
        return isinstance(first, str) or (last >= self.low and first <= self.high)


@dataclass
class Files(InputPartition):
    run: str
    param: str
    group: str
    array: str
    keys: list[str]

    def __post_init__(self) -> None:
        super().__init__(None)


class ChunkReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names, self.ens, self.root = schema.names, _true(options, "ensemble"), options["path"].rstrip("/")
        self.ranges = {c: Range() for c in ("run", "param", "cy", "cx", "iy", "ix", "step")}

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        """Filters prune chunks; those on run, param, cy, cx and step are met in full."""
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") else None
            text = column in ("run", "param")
            usable = (EqualTo, In) if text else (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)
            if column not in self.ranges or not isinstance(f, usable):
                yield f
                continue
            self.ranges[column].take(f)
            if column in ("iy", "ix"):
                yield f

    def _folders(self, path: str, column: str) -> list[str]:
        """Names of the folders below, of the values that the filters leave."""
        from pyarrow import fs as pafs
        filesystem, at = chunks._fs(path)
        found = filesystem.get_file_info(pafs.FileSelector(at, allow_not_found=True))
        names = [f.base_name for f in found if f.type == pafs.FileType.Directory and not f.base_name.startswith(("_", "."))]
        return sorted(n for n in names if self.ranges[column].may(n))

    def _array(self, group: str, param: str) -> str:
        """The group's data array: the one named like the param, else its only one that is no coordinate."""
        meta = json.loads(chunks._get(f"{group}/.zmetadata"))["metadata"]
        arrays = [k.rsplit("/", 1)[0] for k in meta if k.endswith("/.zarray")]
        dims = {d for a in arrays for d in meta.get(f"{a}/.zattrs", {}).get("_ARRAY_DIMENSIONS", ())}
        data = [a for a in arrays if a not in dims]
        if param in data:
            return param
        if len(data) != 1:
            raise ValueError(f"{group}: no array {param} and {len(data)} others")
        return data[0]

    def partitions(self) -> list[Files]:
        from pyarrow import fs as pafs
        out = []
        for run in self._folders(self.root, "run"):
            for param in self._folders(f"{self.root}/{run}", "param"):
                group = f"{self.root}/{run}/{param}"
                if chunks._get(f"{group}/.zmetadata") is None:
                    continue  # not complete
                array = self._array(group, param)
                meta, _, steps = chunks._described(group, array)
                sep, (ch_y, ch_x) = meta.get("dimension_separator", "."), meta["chunks"][-2:]
                if not any(self.ranges["step"].may(int(s)) for s in steps):
                    continue
                filesystem, at = chunks._fs(f"{group}/{array}")
                keys = []
                for f in filesystem.get_file_info(pafs.FileSelector(at, recursive=sep == "/")):
                    key = f.path[len(at):].strip("/")
                    index = key.split(sep)
                    if f.type != pafs.FileType.File or not all(i.isdigit() for i in index):
                        continue
                    cy, cx = map(int, index[-2:])
                    r = self.ranges
                    if (r["cy"].may(cy) and r["cx"].may(cx) and r["iy"].may(cy * ch_y, cy * ch_y + ch_y - 1)
                            and r["ix"].may(cx * ch_x, cx * ch_x + ch_x - 1)):
                        keys.append(key)
                keys.sort()
                out += [Files(run, param, group, array, keys[i:i + PER_TASK]) for i in range(0, len(keys), PER_TASK)]
        return out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        meta, dims, steps = chunks._described(partition.group, partition.array)
        wanted = np.array([self.ranges["step"].may(int(s)) for s in steps], bool)
        sep = meta.get("dimension_separator", ".")
        for key in partition.keys:
            folder = f"{partition.group}/{partition.array}"
            cells = chunks.chunk_cells(meta, dims, steps, folder, key, chunks._get(f"{folder}/{key}"), self.ens, wanted=wanted)
            cy, cx = map(int, key.split(sep)[-2:])
            n = len(cells["value"])
            cells |= {"cy": pa.array(np.full(n, cy, np.int32)), "cx": pa.array(np.full(n, cx, np.int32))}
            yield from chunks._batches({"run": partition.run, "param": partition.param}, cells, self.names)


@dataclass
class Written(WriterCommitMessage):
    """A task's axes, a short row per group it wrote to, and the name of its list of chunk files."""

    axes: dict
    listing: str


_LISTED = pa.schema([("run", pa.string()), ("param", pa.string()), ("cy", pa.int32()), ("cx", pa.int32()),
                     ("file", pa.string()), ("n_bytes", pa.int64())])


class ChunkWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.root, self.listing = options["path"].rstrip("/"), options.get("listing")
        shape = tuple(int(x) for x in options.get("chunk", f"{chunks.grid.CHUNK_LAT},{chunks.grid.CHUNK_LON}").split(","))
        self.how = (shape, int(options.get("level", 5)), _true(options, "ensemble"))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, name = chunks.ChunkFiles(self.root, *self.how), f"{uuid.uuid4().hex}.parquet"
        rows = list(files.write(iterator))
        if self.listing and rows:
            buffer = io.BytesIO()
            pq.write_table(pa.Table.from_pylist(rows, _LISTED), buffer)
            chunks._put(f"{self.root}/_chunks/{self.listing}/{name}", buffer.getvalue())
        return Written(files.axes, name)

    def commit(self, messages: list[Written]) -> None:
        axes: dict[tuple[str, str], dict] = {}
        for m in messages:
            for key, axis in (m.axes if m else {}).items():
                axes.setdefault(key, {**axis, "steps": {}})["steps"].update(axis["steps"])
        files = chunks.ChunkFiles(self.root, *self.how)
        for (run, param), axis in axes.items():  # a row per group
            files.finish(run, param, [axis["steps"][i] for i in range(axis["n_steps"])], axis["n_members"])
        if self.listing:
            from pyarrow import fs as pafs
            filesystem, at = chunks._fs(f"{self.root}/_chunks/{self.listing}")
            filesystem.create_dir(at, recursive=True)
            kept = {m.listing for m in messages if m}
            for f in filesystem.get_file_info(pafs.FileSelector(at)):
                if f.base_name not in kept:  # of an attempt that was run again
                    filesystem.delete_file(f.path)

    def abort(self, messages: list[Written]) -> None:
        """Chunk files without their group's metadata are not part of a group."""
