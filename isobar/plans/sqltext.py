"""Portable SQL text (runs on DuckDB and Spark SQL) for the fixtures X1-X8.

These CTEs restate FIXTURES.md so that an independent engine can rebuild the
same inputs from the driver's tables and check every query.
"""

from __future__ import annotations


def d(x: float) -> str:
    """A DOUBLE literal (bare decimals are DECIMAL in both dialects)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


NAN = "CAST('NaN' AS DOUBLE)"

_RUN_OF_FLAG = ("CASE l_returnflag WHEN 'A' THEN '2026040300' WHEN 'N' THEN '2026040306' "
                "ELSE '2026040312' END")
_VALUE = ("max(lo+(hi-lo)*((CAST(round(l_extendedprice*100) AS BIGINT) % 100000)/" + d(100000.0) + "))")

FIXTURE_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "x1_pm": ((), "x1_pm(n, param, lo, hi) AS (VALUES "
              f"(1,'t_2m',{d(260)},{d(310)}),(2,'td_2m',{d(250)},{d(300)}),"
              f"(3,'u_10m',{d(-20)},{d(20)}),(4,'v_10m',{d(-20)},{d(20)}),"
              f"(5,'asob_s',{d(-20)},{d(800)}),(6,'athb_s',{d(-200)},{d(50)}),"
              f"(7,'ps',{d(60000)},{d(105000)}))"),
    "x1_cells": (("x1_pm",), f"""x1_cells AS (SELECT {_RUN_OF_FLAG} AS run, param,
  CAST(CASE month(l_shipdate) % 6 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2
       WHEN 3 THEN 78 WHEN 4 THEN 81 ELSE 84 END AS INTEGER) AS step,
  CAST(floor(l_partkey/10) AS INTEGER) AS cell,
  {_VALUE} AS value
 FROM lineitem JOIN x1_pm ON l_linenumber = n GROUP BY 1, 2, 3, 4)"""),
    "x1": (("x1_cells",), """x1 AS (SELECT run, param, step, CAST(floor(cell/10) AS INTEGER) AS iy,
  CAST(cell % 10 AS INTEGER) AS ix, value FROM x1_cells)"""),
    "x1n": (("x1_cells",), f"""x1n AS (SELECT run, param, step, CAST(floor(cell/10) AS INTEGER) AS iy,
  CAST(cell % 10 AS INTEGER) AS ix,
  CASE WHEN cell % 7 = 0 AND step = 78 THEN {NAN} ELSE value END AS value FROM x1_cells)"""),
    "x2": ((), """x2 AS (SELECT CAST(year(ts)*1000000+month(ts)*10000+day(ts)*100+hour(ts)-hour(ts)%6 AS VARCHAR) AS run,
  event_type AS param, CAST(hour(ts) % 6 AS INTEGER) AS step, min(event_id % 20000) AS n_bytes,
  CAST(CASE WHEN min(event_id) % 11 = 0 THEN 404 ELSE 200 END AS INTEGER) AS status FROM events GROUP BY 1, 2, 3)"""),
    "x2_expected": (("x2",), """x2_expected AS (SELECT r.run, p.param, CAST(s.step AS INTEGER) AS step
  FROM (SELECT DISTINCT run FROM x2) r, (SELECT DISTINCT param FROM x2) p,
  (VALUES (0),(1),(2),(3),(4),(5)) s(step))"""),
    "x3": ((), f"""x3 AS (SELECT c_custkey AS req_id,
  CAST((c_custkey*37)%1861-930 AS DOUBLE)/{d(10)} AS lat,
  CAST((c_custkey*101)%5501-1850 AS DOUBLE)/{d(10)} AS lon,
  CASE c_custkey%5 WHEN 0 THEN 't_2m' WHEN 1 THEN 'ps' WHEN 2 THEN 'pet_pm' WHEN 3 THEN 'bad' ELSE NULL END AS param,
  CASE WHEN c_custkey%7 = 0 THEN 'true' ELSE NULL END AS ensemble,
  CASE c_custkey%4 WHEN 0 THEN '2026040300' WHEN 1 THEN '2026040306' WHEN 2 THEN '20260403' ELSE NULL END AS run
  FROM customer)"""),
    "x3b": ((), f"""x3b AS (SELECT c_custkey AS req_id,
  {d(90)} - CAST(c_custkey%20 AS DOUBLE)*{d(0.125)} - {d(0.03)} AS lat,
  {d(-180)} + CAST((c_custkey*3)%10 AS DOUBLE)*{d(0.125)} + {d(0.02)} AS lon,
  CASE c_custkey%5 WHEN 0 THEN 't_2m' WHEN 1 THEN 'ps' WHEN 2 THEN 'pet_pm' WHEN 3 THEN 'bad' ELSE NULL END AS param,
  CASE WHEN c_custkey%7 = 0 THEN 'true' ELSE NULL END AS ensemble,
  CASE c_custkey%4 WHEN 0 THEN '2026040300' WHEN 1 THEN '2026040306' WHEN 2 THEN '20260403' ELSE NULL END AS run
  FROM customer)"""),
    "x4": (("x1_cells",), """x4_m AS (SELECT DISTINCT run, param FROM x1_cells),
x4 AS (SELECT run, param, '_SUCCESS' AS marker, CAST(NULL AS VARCHAR) AS payload,
  CAST(strptime(run, '%Y%m%d%H') AS TIMESTAMP) + INTERVAL 4 HOUR AS ts
  FROM x4_m WHERE NOT (run = '2026040306' AND param = 'ps')
 UNION ALL SELECT DISTINCT run, CAST(NULL AS VARCHAR), '_PROMOTED', CAST(NULL AS VARCHAR),
  CAST(strptime(run, '%Y%m%d%H') AS TIMESTAMP) + INTERVAL 5 HOUR FROM x4_m WHERE run <> '2026040312')"""),
    "x4l": (("x4",), """x4l_runs AS (SELECT run, bool_or(marker = '_PROMOTED') AS promoted FROM x4 GROUP BY run),
x4l AS (SELECT * FROM x4
 UNION ALL SELECT run, CAST(NULL AS VARCHAR), '_LATEST_RUN', run,
  CAST(strptime(run, '%Y%m%d%H') AS TIMESTAMP) + INTERVAL 6 HOUR FROM x4l_runs WHERE promoted
 UNION ALL SELECT u.run, CAST(NULL AS VARCHAR), '_RESOLVED_RUN', max(p.run),
  CAST(strptime(u.run, '%Y%m%d%H') AS TIMESTAMP) + INTERVAL 1 HOUR
  FROM x4l_runs u JOIN x4l_runs p ON p.promoted AND p.run < u.run WHERE NOT u.promoted GROUP BY u.run)"""),
    "x5": (("x1_cells",), """x5 AS (SELECT CAST(d.cell AS BIGINT) AS dst_id, CAST((d.cell*2+k)%n AS BIGINT) AS src_id,
  CASE k WHEN 0 THEN CAST(0.5 AS DOUBLE) WHEN 1 THEN CAST(0.3 AS DOUBLE) ELSE CAST(0.2 AS DOUBLE) END AS w
  FROM (SELECT DISTINCT cell FROM x1_cells) d CROSS JOIN (VALUES (0),(1),(2)) kk(k)
  CROSS JOIN (SELECT max(cell)+1 AS n FROM x1_cells) nn WHERE d.cell*2 < n)"""),
    "x5_native": (("x1_cells",), """x5_native AS (SELECT run, param, 0 AS member, step, CAST(cell AS BIGINT) AS src_id, value
  FROM x1_cells)"""),
    "x6_src": ((), f"""x6_src AS (SELECT s_suppkey AS src_id, CAST((s_suppkey*377)%1801-900 AS DOUBLE)/{d(10)} AS lat,
  CAST((s_suppkey*1013)%3600-1800 AS DOUBLE)/{d(10)} AS lon FROM supplier)"""),
    "x6_dst": ((), f"""x6_dst AS (SELECT CAST(n_nationkey AS BIGINT) AS dst_id,
  CAST(n_nationkey%5 AS DOUBLE)*{d(40)}-{d(80)} AS lat,
  CAST(floor(n_nationkey/5) AS DOUBLE)*{d(72)}-{d(180)} AS lon FROM nation)"""),
    "x7": (("x1_pm",), f"""x7 AS (SELECT '2026040300' AS run, param, CAST(l_suppkey%4 AS INTEGER) AS member,
  CAST(month(l_shipdate)%6 AS INTEGER) AS step, CAST(floor(floor(l_partkey/10)/10) AS INTEGER) AS iy,
  CAST(floor(l_partkey/10) AS INTEGER) % 10 AS ix,
  {_VALUE} AS value FROM lineitem JOIN x1_pm ON l_linenumber = n GROUP BY 1, 2, 3, 4, 5, 6)"""),
    "x8": ((), """x8 AS (SELECT user_id AS client, event_id AS req_id, ts FROM events)"""),
}


def with_fixtures(names, body: str) -> str:
    """``WITH <fixture CTEs in dependency order>, <body>``.

    ``body`` either starts with SELECT or continues the CTE list.
    """
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in FIXTURE_CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(FIXTURE_CTES[n][1] for n in order)
    body = body.strip()
    sep = "\n" if body.upper().startswith("SELECT") else ",\n"
    return f"WITH {ctes}{sep}{body}"
