"""R1 rate_audit: per-client request limit with a renewing expiry.

Rule: a client's counter starts at 0.  A request is allowed while the
counter is below ``limit``; an allowed request adds one and renews the
expiry to ``ts + expiry``; a denied one changes nothing.  At or after the
expiry the counter is back to 0.

Batch plan (exact, skew-aware):
1. A gap of at least ``expiry`` between two requests of a client resets the
   counter, so it cuts the client's requests into independent sessions.
   Inside one time bucket of width ``expiry`` consecutive requests are closer
   than ``expiry``, so only the first request of a bucket can open a session;
   session starts therefore come from a per-(client, bucket) min/max
   aggregate (map-side combined) joined to the previous bucket, and a running
   max over the - few - buckets of a client names each session.  No step
   orders all requests of a client in one task.
2. A session with at most ``limit`` requests is entirely allowed (built-ins).
3. Sessions of up to ``WHOLE`` requests are replayed in one sorted pass,
   hash-partitioned by (client, session), a batch at a time.
4. Longer sessions are cut into time blocks, hash-partitioned by (client,
   session, block).  A block's task finds, for every state in which the block
   may be entered, the state behind it (epochs follow from their first
   request alone, so this is one pass of pointer jumps).  These small tables
   are composed along a session's blocks, which gives each block's entry
   state, and the blocks are then replayed side by side, jumping from epoch to
   epoch.  So one client, or one session without any pause, spreads over many
   tasks.

Stream plan: ``applyInPandasWithState`` keyed by client with state
(count, expiry, rows buffered until the watermark passes them); ready rows
are replayed in (ts, req_id) order with the same function, and the state is
dropped in event time once it has expired.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.window import Window
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType, TimestampNTZType

RATE_LIMIT = 100
RATE_WINDOW_S = 60

OUT_SCHEMA = StructType([
    StructField("client", LongType()), StructField("req_id", LongType()),
    StructField("ts", TimestampNTZType()), StructField("allowed", BooleanType()),
])


def replay(t_us: np.ndarray, count: int, expiry: int, limit: int, expiry_us: int):
    """Allowed flags for one client's requests (sorted times in microseconds),
    starting from state (count, expiry); returns (allowed, count, expiry)."""
    n = len(t_us)
    allowed = np.zeros(n, dtype=bool)
    big = np.flatnonzero(np.diff(t_us) >= expiry_us) + 1  # requests after a long gap
    i = 0
    while i < n:
        if t_us[i] >= expiry:
            count = 0
        if count < limit:
            j = min(i + (limit - count), n)
            b = big[np.searchsorted(big, i, side="right"):]
            if len(b) and b[0] < j:
                j = int(b[0])  # the state expires at j: a new epoch starts there
            allowed[i:j] = True
            count += j - i
            expiry = int(t_us[j - 1]) + expiry_us
            i = j
        else:
            i = int(np.searchsorted(t_us, expiry, side="left"))
    return allowed, count, expiry


def replay_sessions(t_us: np.ndarray, start: np.ndarray, end: np.ndarray, limit: int, expiry_us: int) -> np.ndarray:
    """Allowed flags of whole sessions (no pause of ``expiry_us`` inside), all sessions side by side.

    An epoch allows ``limit`` requests from its first one; the next epoch opens
    at the first request at or after the expiry that its last one set.
    """
    # session times one after the other on one axis, too far apart to meet
    span = t_us[end - 1] - t_us[start] + 2 * expiry_us
    shift = np.cumsum(span) - span - t_us[start]
    axis = t_us + np.repeat(shift, end - start)
    edge = np.zeros(len(t_us) + 1, np.int64)
    at, stop = start, end
    while len(at):
        last = np.minimum(at + limit, stop)
        np.add.at(edge, at, 1)
        np.add.at(edge, last, -1)
        at, stop, last = (x[last < stop] for x in (at, stop, last))
        at = np.searchsorted(axis, axis[last - 1] + expiry_us)
        at, stop = at[at < stop], stop[at < stop]
    return np.cumsum(edge[:-1]) > 0


def _times_us(ts: pd.Series) -> np.ndarray:
    return ts.to_numpy(dtype="datetime64[us]").astype(np.int64)


def sessions(log: DataFrame, expiry_us: int) -> DataFrame:
    """log + ``_s`` (bucket of the session start) and ``_sn`` (session size)."""
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    x = log.select("client", "req_id", "ts", t.alias("_t")).withColumn("_b", F.floor(F.col("_t") / F.lit(expiry_us)))
    b = x.groupBy("client", "_b").agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi"),
                                      F.count(F.lit(1)).alias("_n"))
    prev = b.select("client", (F.col("_b") + 1).alias("_b"), F.col("_hi").alias("_phi"))
    start = F.col("_phi").isNull() | (F.col("_lo") - F.col("_phi") >= F.lit(expiry_us))
    upto = Window.partitionBy("client").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    b = (b.join(prev, ["client", "_b"], "left")
         .withColumn("_s", F.max(F.when(start, F.col("_b"))).over(upto)))
    b = b.withColumn("_sn", F.sum("_n").over(Window.partitionBy("client", "_s")))
    return x.join(b.select("client", "_b", "_s", "_sn"), ["client", "_b"]).drop("_b", "_t")


#: Requests that one task replays of one session; longer sessions are cut into blocks.
WHOLE = 1_000_000
#: Width of a block of a long session, in expiries.
BLOCK_EXPIRIES = 16
_MIN = np.iinfo(np.int64).min


def block_exits(t: np.ndarray, start: int, limit: int, expiry_us: int) -> dict[str, np.ndarray]:
    """Where a block of a session leaves the counter, for every way to enter it.

    ``t`` are the block's sorted times, ``start`` the block's own start.  The
    state between requests is (count, expiry).  ``c_count``/``c_expiry`` answer
    an entry with a count of 1 .. limit - 1 (consecutive requests of a session
    are closer than the expiry, so the count goes on).  A full counter opens a
    new epoch at the first request at or after its expiry, which is less than
    ``start + expiry_us``: ``x_upto`` are the last expiries that share an
    answer ``x_count``/``x_expiry``; a later one passes through the block.
    """
    n = len(t)
    i = np.arange(n)
    end = np.minimum(i + limit - 1, n - 1)
    full = i + limit - 1 < n                 # the epoch opened at i uses up its limit here
    after = t[end] + expiry_us
    nxt = np.where(full, np.searchsorted(t, after), n)
    to = np.where(nxt < n, nxt, i)           # the next epoch, or the last one to open here
    while True:
        far = to[to]
        if (far == to).all():
            break
        to = far
    count, expiry = np.where(full[to], limit, n - to), np.where(full[to], after[to], t[-1] + expiry_us)
    c = np.arange(1, limit)
    last = np.minimum(limit - c - 1, n - 1)  # the request that fills the counter, if the block reaches it
    reached = limit - c - 1 < n
    follow = np.searchsorted(t, t[last] + expiry_us)
    opens = reached & (follow < n)
    at = np.minimum(follow, n - 1)
    c_count = np.where(opens, count[at], np.where(reached, limit, c + n))
    c_expiry = np.where(opens, expiry[at], np.where(reached, t[last], t[-1]) + expiry_us)
    # entries by expiry: the first request of each time within the first expiry, and the one after
    first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
    first = first[:int(np.searchsorted(t[first], start + expiry_us)) + 1]
    run_end = np.r_[(count[first][1:] != count[first][:-1]) | (expiry[first][1:] != expiry[first][:-1]), True]
    first = first[run_end]
    return {"c_count": c_count, "c_expiry": c_expiry, "x_upto": t[first], "x_count": count[first], "x_expiry": expiry[first],
            "from_zero": np.array([count[0], expiry[0]])}


def enter(block: dict[str, np.ndarray], count: int, expiry: int, limit: int) -> tuple[int, int]:
    """The state behind a block that is entered with (count, expiry)."""
    if count == 0:
        return int(block["from_zero"][0]), int(block["from_zero"][1])
    if count < limit:
        return int(block["c_count"][count - 1]), int(block["c_expiry"][count - 1])
    k = int(np.searchsorted(block["x_upto"], expiry))
    if k == len(block["x_upto"]):
        return count, expiry
    return int(block["x_count"][k]), int(block["x_expiry"][k])


_KEYS = ["client", "_s", "_k"]
_TABLES = ("c_count", "c_expiry", "x_upto", "x_count", "x_expiry", "from_zero")
_EXITS = "client long, _s long, _k long, " + ", ".join(f"{c} array<long>" for c in _TABLES)


def _runs(pdf: pd.DataFrame, keys: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """(key, first, end) of the runs of equal keys."""
    k = pdf[keys].to_numpy()
    first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)]) if len(k) else np.zeros(0, int)
    return list(map(tuple, k[first].tolist())), first, np.r_[first[1:], len(k)]


def session_entries(long_rows: DataFrame, limit: int, expiry_us: int, blocks: int) -> DataFrame:
    """(client, _s, _k, count, expiry): the state in which each block of each session is entered."""
    width = blocks * expiry_us

    def exits(batches):
        key, times = None, []

        def out() -> tuple:
            tables = block_exits(np.concatenate(times), key[2] * width, limit, expiry_us)
            return (*key, *(tables[c] for c in _TABLES))
        for pdf in batches:
            t, done = _times_us(pdf["ts"]), []
            for k, a, b in zip(*_runs(pdf, _KEYS)):
                if k != key:
                    if key is not None:
                        done.append(out())
                    key, times = k, []
                times.append(t[a:b])
            yield pd.DataFrame(done, columns=[*_KEYS, *_TABLES])
        if key is not None:
            yield pd.DataFrame([out()], columns=[*_KEYS, *_TABLES])

    def compose(batches):
        session, count, expiry = None, 0, _MIN
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                if (r["client"], r["_s"]) != session:
                    session, count, expiry = (r["client"], r["_s"]), 0, _MIN
                rows.append((*session, r["_k"], count, expiry))
                count, expiry = enter({c: np.asarray(r[c]) for c in _TABLES}, count, expiry, limit)
            yield pd.DataFrame(rows, columns=[*_KEYS, "count", "expiry"])

    per_block = (long_rows.select(*_KEYS, "ts", "req_id").repartition(*_KEYS).sortWithinPartitions(*_KEYS, "ts", "req_id")
                 .mapInPandas(exits, _EXITS))
    # a few numbers per block; one task walks a session's blocks in order
    return (per_block.repartition("client", "_s").sortWithinPartitions(*_KEYS)
            .mapInPandas(compose, "client long, _s long, _k long, count long, expiry long"))


def rate_audit(log: DataFrame, limit: int = RATE_LIMIT, expiry_s: float = RATE_WINDOW_S,
               blocks: int = BLOCK_EXPIRIES, whole: int = WHOLE) -> DataFrame:
    """R1 (batch): every request of ``log(client, req_id, ts)`` with ``allowed``.

    Both ways to replay a session are exact; ``whole`` only says which one is taken.
    """
    exp_us = int(round(expiry_s * 1_000_000))
    s = sessions(log.select("client", "req_id", "ts"), exp_us)
    n = F.col("_sn")
    short = s.where(n <= limit).select("client", "req_id", "ts", F.lit(True).alias("allowed"))
    middle = s.where((n > limit) & (n <= whole)).select("client", "_s", "req_id", "ts")
    k = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(blocks * exp_us))
    long_rows = s.where((n > limit) & (n > whole)).select("client", "_s", k.cast("long").alias("_k"), "req_id", "ts")
    entries = session_entries(long_rows, limit, exp_us, blocks)

    def mark(keys: list[str]):
        def run(batches):
            key, count, expiry = None, 0, _MIN
            for pdf in batches:
                if pdf.empty:
                    continue
                t_us, allowed = _times_us(pdf["ts"]), np.zeros(len(pdf), dtype=bool)
                found, first, end = _runs(pdf, keys)
                if "count" not in pdf and len(first) > 2:  # sessions that begin and end here
                    a, b = first[1], end[-2]
                    allowed[a:b] = replay_sessions(t_us[a:b], first[1:-1] - a, end[1:-1] - a, limit, exp_us)
                    found, first, end = [found[0], found[-1]], first[[0, -1]], end[[0, -1]]
                for k, a, b in zip(found, first, end):
                    if k != key:  # a session starts afresh, a block in the state in which it is entered
                        key, count, expiry = k, 0, _MIN
                        if "count" in pdf:
                            count, expiry = int(pdf["count"].iat[a]), int(pdf["expiry"].iat[a])
                    allowed[a:b], count, expiry = replay(t_us[a:b], count, expiry, limit, exp_us)
                yield pd.DataFrame({"client": pdf["client"].to_numpy(), "req_id": pdf["req_id"].to_numpy(),
                                    "ts": pdf["ts"].to_numpy(), "allowed": allowed})
        return run

    session = _KEYS[:2]
    replayed = (middle.repartition(*session).sortWithinPartitions(*session, "ts", "req_id").mapInPandas(mark(session), OUT_SCHEMA))
    marked = (long_rows.join(entries, _KEYS).repartition(*_KEYS).sortWithinPartitions(*_KEYS, "ts", "req_id")
              .select(*_KEYS, "req_id", "ts", "count", "expiry").mapInPandas(mark(_KEYS), OUT_SCHEMA))
    return short.unionByName(replayed).unionByName(marked)


STATE_SCHEMA = StructType([
    StructField("count", LongType()), StructField("expiry_us", LongType()),
    StructField("pend_ts", ArrayType(LongType())), StructField("pend_id", ArrayType(LongType())),
])


def rate_audit_stream(log_stream: DataFrame, limit: int = RATE_LIMIT, expiry_s: float = RATE_WINDOW_S,
                      watermark: str = "1 minute") -> DataFrame:
    """R1 (stream): the same rule as a stateful streaming operator.

    Each client's rows are buffered in state until the watermark passes them
    and are then replayed in (ts, req_id) order, so rows that arrive out of
    order - but within the allowed lateness ``watermark`` - get the verdicts
    of the batch job; rows later than the watermark are dropped by Spark.
    The replay runs on arrival of new rows and on event-time timeouts (armed
    at the oldest buffered row), and the state of a client is removed once
    its counter has expired and nothing is buffered - all in event time,
    never processing time.  Readiness is judged at the watermark's
    millisecond resolution.
    """
    exp_us = int(round(expiry_s * 1_000_000))

    def step(key, pdfs, state):
        wm_ms = state.getCurrentWatermarkMs()
        if state.exists:
            count, expiry, pts, pid = state.get
            t = [np.asarray(pts or [], dtype=np.int64)]
            ids = [np.asarray(pid or [], dtype=np.int64)]
        else:
            count, expiry, t, ids = 0, _MIN, [], []
        for pdf in pdfs:
            t.append(_times_us(pdf["ts"]))
            ids.append(pdf["req_id"].to_numpy(dtype=np.int64))
        t = np.concatenate(t) if t else np.zeros(0, dtype=np.int64)
        ids = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int64)
        order = np.lexsort((ids, t))
        t, ids = t[order], ids[order]
        ready = int(np.searchsorted(t // 1000, wm_ms, side="right")) if wm_ms > 0 else 0
        if ready:
            allowed, count, expiry = replay(t[:ready], count, expiry, limit, exp_us)
            yield pd.DataFrame({"client": np.full(ready, key[0], dtype=np.int64), "req_id": ids[:ready],
                                "ts": pd.to_datetime(t[:ready], unit="us"), "allowed": allowed})
        t, ids = t[ready:], ids[ready:]
        if len(t) == 0 and wm_ms > 0 and wm_ms * 1000 >= expiry:
            state.remove()  # expired and nothing buffered: a new row starts from scratch
            return
        state.update((int(count), int(expiry), t.tolist(), ids.tolist()))
        due = int(t[0] // 1000) - 1 if len(t) else int(expiry // 1000) + 1
        state.setTimeoutTimestamp(max(due, wm_ms + 1))

    # event time must be TIMESTAMP (session zone UTC keeps wall-clock values)
    s = log_stream.select("client", "req_id", F.col("ts").cast("timestamp").alias("ts"))
    return (s.withWatermark("ts", watermark).groupBy("client")
            .applyInPandasWithState(step, OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout))
