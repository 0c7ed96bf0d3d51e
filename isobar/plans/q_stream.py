"""Queries: request auditing (R1) as a batch job and as a one-batch stream."""

from __future__ import annotations

import uuid

from ..session import shared_dir
from ..sources import fixtures as fx
from ..streaming import ratelimit
from .catalog import register
from .sqltext import with_fixtures

# Fixture parameters (FIXTURES.md X8): limit 2 requests, expiry 6 hours.
LIMIT, EXPIRY_S = 2, 6 * 3600

_R1_SQL = with_fixtures(["x8"], """
o AS (SELECT client, req_id, ts, row_number() OVER (PARTITION BY client ORDER BY ts, req_id) AS rn FROM x8),
r AS (SELECT client, rn, req_id, ts, true AS allowed, 1 AS cnt, ts + INTERVAL 6 HOUR AS ex FROM o WHERE rn = 1
  UNION ALL
  SELECT client, rn, req_id, ts, c < 2 AS allowed, CASE WHEN c < 2 THEN c + 1 ELSE c END AS cnt,
    CASE WHEN c < 2 THEN ts + INTERVAL 6 HOUR ELSE ex END AS ex
  FROM (SELECT o.client, o.rn, o.req_id, o.ts, r.ex, CASE WHEN o.ts >= r.ex THEN 0 ELSE r.cnt END AS c
        FROM r JOIN o ON o.client = r.client AND o.rn = r.rn + 1) z)
SELECT client, req_id, ts, allowed FROM r""").replace("WITH ", "WITH RECURSIVE ", 1)


@register("R1_rate_audit", _R1_SQL)
def r1_rate_audit(spark, sf):
    return ratelimit.rate_audit(fx.x8_request_log(spark, sf), LIMIT, EXPIRY_S)


@register("R1_rate_audit_stream", _R1_SQL)
def r1_rate_audit_stream(spark, sf):
    """The request log replayed as a stream (one availableNow batch) into a
    parquet sink with a checkpoint, then read back."""
    base = shared_dir(spark, f"r1-stream-{uuid.uuid4().hex}")
    src = f"{base}/source"
    log = fx.x8_request_log(spark, sf)
    log.write.parquet(src)
    stream = spark.readStream.schema(log.schema).parquet(src)
    # the log is complete and ordered: no lateness to allow
    q = (ratelimit.rate_audit_stream(stream, LIMIT, EXPIRY_S, watermark="0 seconds").writeStream.format("parquet")
         .option("path", f"{base}/sink").option("checkpointLocation", f"{base}/checkpoint")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(ratelimit.OUT_SCHEMA).parquet(f"{base}/sink")
