"""SQL restatement of W1 -> J4 -> D1 (used by the DuckDB oracle)."""

from __future__ import annotations

from ..functions import physics as ph
from .sqltext import NAN, d

PET_INPUTS = ("t_2m", "td_2m", "u_10m", "v_10m", "asob_s", "athb_s", "ps")


def deaccumulate_sql(src: str, name: str, params=("asob_s", "athb_s"),
                     part: str = "run, param, iy, ix") -> str:
    t = "CAST(step AS DOUBLE)"
    pt = f"coalesce(lag({t}) OVER w, {d(0)})"
    pv = f"coalesce(CASE WHEN isnan(lag(value) OVER w) THEN {d(0)} ELSE lag(value) OVER w END, {d(0)})"
    plist = ", ".join(f"'{p}'" for p in params)
    cols = "run, param, " + ("member, " if "member" in part else "") + "step, iy, ix"
    return f"""{name} AS (SELECT {cols},
  CASE WHEN param IN ({plist}) THEN
    CASE WHEN {t} - {pt} > 0 THEN (value * {t} - {pv} * {pt}) / ({t} - {pt}) ELSE {d(0)} END
  ELSE value END AS value
 FROM {src} WINDOW w AS (PARTITION BY {part} ORDER BY step))"""


def align_sql(src: str, name: str, params=PET_INPUTS, lead: str = "run") -> str:
    plist = ", ".join(f"'{p}'" for p in params)
    cols = ",\n  ".join(f"max(CASE WHEN param = '{p}' THEN value END) AS {p}" for p in params)
    return f"""{name} AS (SELECT {lead}, step, iy, ix,
  {cols}
 FROM {src} WHERE param IN ({plist}) GROUP BY {lead}, step, iy, ix HAVING count(*) = {len(params)})"""


def pet_select_sql(src: str, lead: str = "run") -> str:
    """SELECT producing (lead, step, iy, ix, pet_pm) from aligned columns."""
    return f"""pet_t AS (SELECT {lead}, step, iy, ix, t_2m - {d(ph.KELVIN)} AS t, td_2m - {d(ph.KELVIN)} AS td,
  u_10m, v_10m, asob_s, athb_s, ps FROM {src}),
pet_e AS (SELECT *,
  {d(ph.MAGNUS_A)} * exp({d(ph.MAGNUS_B)} * t / (t + {d(ph.MAGNUS_C)})) AS es,
  {d(ph.MAGNUS_A)} * exp({d(ph.MAGNUS_B)} * td / (td + {d(ph.MAGNUS_C)})) AS ea,
  sqrt(u_10m * u_10m + v_10m * v_10m) * {d(ph.WIND_10M_TO_2M)} AS u2,
  (asob_s + athb_s) * {d(ph.W_M2_TO_MJ_M2_H)} AS rn,
  {d(ph.PSYCHRO)} * (ps / {d(1000)}) AS gamma FROM pet_t),
pet_f AS (SELECT *, CASE WHEN es - ea < 0 THEN {d(0)} ELSE es - ea END AS vpd,
  ({d(ph.SLOPE_NUM)} * es) / ((t + {d(ph.MAGNUS_C)}) * (t + {d(ph.MAGNUS_C)})) AS delta FROM pet_e),
pet_g AS (SELECT {lead}, step, iy, ix,
  ({d(ph.RAD_COEF)} * delta * rn + gamma * ({d(ph.AERO_COEF)} / (t + {d(ph.KELVIN)})) * u2 * vpd)
  / (delta + gamma * ({d(1)} + {d(ph.WIND_COEF)} * u2)) AS et0 FROM pet_f),
pet_h AS (SELECT {lead}, step, iy, ix, CASE WHEN isfinite(et0) THEN et0 ELSE {NAN} END AS et0 FROM pet_g)
SELECT {lead}, step, iy, ix, CAST(CASE WHEN et0 < 0 THEN {d(0)} ELSE et0 END AS FLOAT) AS pet_pm FROM pet_h"""


def pet_cte_sql(src: str = "x1") -> str:
    """CTEs ending in ``pet(run, step, iy, ix, pet_pm)`` computed from field ``src``."""
    body = pet_select_sql("al")
    head, _, final = body.rpartition("\nSELECT ")
    return (deaccumulate_sql(src, "w1") + ",\n" + align_sql("w1", "al") + ",\n" + head
            + ",\npet AS (SELECT " + final + ")")
