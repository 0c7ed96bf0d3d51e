"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of slots; rows and bytes are summed per
slot; a versioned map says which shard owns a slot.  Version 1 deals the slots
out in turn.  Rebalancing edits the map: shards above the mean give up slots,
which go to the shards with least bytes, as a new version.  Records never move
between slots, so an edit names exactly the slots whose records move.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isobar.llm.common import fresh, written
from isobar.session import shared_dir

SHARDS = 40
SLOTS = 8192
#: Bytes that a record takes besides its text.
OVERHEAD = 16
#: Columns that the result has besides those of the documents.
OWN = ("size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot", "map_version")
MAP = "map_version int, slot_id int, shard int"


@dataclass
class SlotMap:
    """Owner of every slot, by version; the last version rules."""

    versions: list[list[int]]

    @classmethod
    def dealt(cls, slots: int, shards: int) -> SlotMap:
        return cls([[s % shards for s in range(slots)]])

    @property
    def owner(self) -> list[int]:
        return self.versions[-1]

    def rebalance(self, load: list[int], shards: int) -> SlotMap:
        """A further version with near equal bytes per shard.

        ``load`` has the bytes of each slot (its length is fixed, whatever the
        corpus).  A shard keeps its heaviest slots up to the mean (of the slots that do not
        outweigh a shard by themselves); the others
        go, heaviest first, to the lightest shard.  Empty slots stay.
        """
        rest, free = sum(load), shards
        for x in sorted(load, reverse=True):  # a slot above the mean has a shard to itself
            if free < 2 or x * free <= rest:
                break
            rest, free = rest - x, free - 1
        mean = rest / free
        kept, loose = [0] * shards, []
        owner = list(self.owner)
        for s in sorted(range(len(load)), key=lambda s: (-load[s], s)):
            at = owner[s]
            if load[s] and (at >= shards or kept[at] and kept[at] + load[s] > mean):
                loose.append(s)
            else:
                owner[s] = at if at < shards else s % shards
                kept[owner[s]] += load[s]
        heap = [(b, k) for k, b in enumerate(kept)]
        heapq.heapify(heap)
        for s in loose:  # heaviest first, as collected
            b, k = heapq.heappop(heap)
            owner[s] = k
            heapq.heappush(heap, (b + load[s], k))
        return SlotMap([*self.versions, owner])

    def rows(self) -> list[tuple[int, int, int]]:
        return [(v, s, k) for v, owner in enumerate(self.versions, 1) for s, k in enumerate(owner)]


def load_map(spark: SparkSession, path: str) -> SlotMap | None:
    """The versions stored at ``path``; None if there are none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    rows = spark.read.schema(MAP).parquet(path).collect()  # slots times versions
    versions: dict[int, dict[int, int]] = {}
    for v, s, k in rows:
        versions.setdefault(v, {})[s] = k
    return SlotMap([[versions[v][s] for s in range(len(versions[v]))] for v in sorted(versions)]) if rows else None


def store_map(spark: SparkSession, plan: SlotMap, path: str, known: int = 0) -> None:
    """Add the versions after the ``known`` first ones to the map at ``path``."""
    rows = [r for r in plan.rows() if r[0] > known]
    if rows:
        spark.createDataFrame(rows, MAP).coalesce(1).write.mode("append").parquet(path)


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _numbered(rows: DataFrame, id_: str, crc: str, at: str, copy: str) -> DataFrame:
    """rows (a written table with row numbers ``at``) with ``copy``: 0, 1, .. among rows equal in id and crc.

    Counts per (group, reading task) are summed up first, so no task orders a whole group.
    """
    part, g, c, p, before = (fresh(rows, n) for n in ("part", "g", "c", "p", "before"))
    rows = rows.withColumn(part, F.shiftright(at, 33))
    mine = Window.partitionBy("g", "c")
    counts = (rows.groupBy(F.col(id_).alias("g"), F.col(crc).alias("c"), F.col(part).alias("p")).agg(F.count(F.lit(1)).alias("n"))
              .select(F.col("g").alias(g), F.col("c").alias(c), F.col("p").alias(p), (F.sum("n").over(mine.orderBy("p")) - F.col("n")).alias(before)))
    met = rows.join(counts, F.col(id_).eqNullSafe(F.col(g)) & (F.col(crc) == F.col(c)) & (F.col(part) == F.col(p)))
    inner = F.row_number().over(Window.partitionBy(id_, crc, part).orderBy(at)) - 1
    return met.withColumn(copy, F.col(before) + inner).drop(part, g, c, p, before)


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, keep: list[str] | None = None,
          map_path: str | None = None) -> DataFrame:
    """Assign every row to a shard so that the shards' bytes are near equal.

    Returns ``keep`` (default doc_id), size, text_crc32, law ('bytes'), shard,
    slot (the row's place in its shard, 0 to n - 1 without gaps), grown_shard
    (null under this law), virtual_slot and map_version.  Where a kept column
    has such a name, it stays, and the result's own gets an underscore in front.

    With ``map_path`` the last version of the map stored there is rebalanced
    for this load and the new version added to it, so only rows of the slots
    that the edit names move; a first call deals the slots out.

    Null text: no bytes, crc32 of the empty text.  Null ids are hashed with the
    text.  Rows equal in id and text share a virtual slot unless they outweigh
    an average slot; then each hashes with its number among them, so repeated
    rows spread like others.  A text larger than the mean shard makes that shard
    larger.  Empty tables give an empty result.  Texts are only measured and
    hashed; slim columns are stored and shuffled unless ``keep`` asks for more.
    """
    spark = docs.sparkSession
    extra = [c for c in keep or ["doc_id"]]
    plain = docs.select(*extra, *({"doc_id", "text"} - set(extra))) if keep else docs.select("doc_id", "text")
    own = {c: fresh(docs.select(*extra), c) for c in OWN}
    names = ("bytes", "crc", "at", "copy", "virtual", "slot_id", "first", "place", "g", "c", "owner")
    n = {x: fresh(plain, "shard_" + x) for x in names}
    rows = plain.withColumns({n["crc"]: F.crc32(F.encode(_text(), "UTF-8")), n["bytes"]: (F.octet_length(_text()) + OVERHEAD).cast("long")})
    rows = rows.drop(*({"doc_id", "text"} - {*extra, "doc_id"}))
    if not keep:
        rows = written(rows, "shard-rows")
    # groups of equal rows that outweigh an average slot: fewer than there are slots
    groups = written(rows.groupBy(F.col("doc_id").alias(n["g"]), F.col(n["crc"]).alias(n["c"]))
                     .agg(F.sum(n["bytes"]).alias("b"), F.count(F.lit(1)).alias("n")), "shard-groups")
    total = groups.agg(F.sum("b")).first()[0] or 0
    heavy = groups.where((F.col("n") > 1) & (F.col("b") * F.lit(slots) > F.lit(total))).select(n["g"], n["c"])
    same = F.col("doc_id").eqNullSafe(F.col(n["g"])) & (F.col(n["crc"]) == F.col(n["c"]))
    at = written(rows.join(F.broadcast(heavy), same, "left_semi").withColumn(n["at"], F.monotonically_increasing_id()), "shard-heavy")
    spread = _numbered(at, "doc_id", n["crc"], n["at"], n["copy"]).drop(n["at"])
    light = rows.join(F.broadcast(heavy), same, "left_anti").withColumn(n["copy"], F.lit(0).cast("long"))
    every = light.unionByName(spread).withColumn(n["virtual"], F.pmod(F.xxhash64("doc_id", n["crc"], n["copy"]), F.lit(slots)).cast("int"))
    # one row per slot: at most ``slots`` rows reach the driver
    found = {r[0]: (r["b"], r["n"]) for r in every.groupBy(n["virtual"]).agg(F.sum(n["bytes"]).alias("b"), F.count("*").alias("n")).collect()}
    before = load_map(spark, map_path) if map_path else None
    if before and len(before.owner) != slots:
        raise ValueError(f"{map_path} has {len(before.owner)} slots, not {slots}")
    plan = (before or SlotMap.dealt(slots, shards)).rebalance([found.get(s, (0, 0))[0] for s in range(slots)], shards)
    store_map(spark, plan, map_path or f"{shared_dir(spark, 'llm')}/slot-map-{uuid.uuid4().hex}", len(before.versions) if before else 0)
    # places: a slot's rows follow those of the shard's earlier slots
    filled, owner = [0] * shards, []
    for s, k in enumerate(plan.owner):
        owner.append((s, k, filled[k]))
        filled[k] += found.get(s, (0, 0))[1]
    current = F.broadcast(spark.createDataFrame(owner, f"{n['slot_id']} int, {n['owner']} int, {n['first']} long"))  # ``slots`` rows
    place = F.row_number().over(Window.partitionBy(n["virtual"]).orderBy("doc_id", n["crc"], n["bytes"])) - 1
    return (every.withColumn(n["place"], place).join(current, F.col(n["virtual"]) == F.col(n["slot_id"]))
            .select(*extra, F.col(n["bytes"]).alias(own["size"]), F.col(n["crc"]).alias(own["text_crc32"]), F.lit("bytes").alias(own["law"]),
                    F.col(n["owner"]).alias(own["shard"]), (F.col(n["first"]) + F.col(n["place"])).cast("long").alias(own["slot"]),
                    F.lit(None).cast("int").alias(own["grown_shard"]), F.col(n["virtual"]).alias(own["virtual_slot"]),
                    F.lit(len(plan.versions)).alias(own["map_version"])))
