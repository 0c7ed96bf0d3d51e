"""Engine-independent number text for JSON bodies (as JavaScript prints them).

Spark and other engines print doubles differently (``5.0E-4`` vs ``0.0005``);
a fixed-scale decimal with trailing zeros stripped prints the same text as
``JSON.stringify`` for values rounded to that scale.  NaN and infinities are
``null``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def js_number(x: Column, scale: int) -> Column:
    txt = x.cast(f"decimal(38,{scale})").cast("string")
    txt = F.regexp_replace(txt, r"\.?0+$", "")
    return F.when(F.abs(x) < F.lit(float("inf")), txt).otherwise(F.lit("null"))


def js_double(x: Column) -> Column:
    """A coordinate as it was given: all its digits, no exponent, no trailing ``.0``."""
    txt = F.regexp_replace(x.cast("string"), r"\.0$", "")
    plain = F.regexp_replace(x.cast("decimal(38,24)").cast("string"), r"\.?0+$", "")
    return F.when(F.abs(x) < F.lit(float("inf")), F.when(txt.contains("E"), plain).otherwise(txt)).otherwise(F.lit("null"))


def js_string(x: Column) -> Column:
    """A JSON string literal (values are validated identifiers: no escaping needed)."""
    return F.concat(F.lit('"'), x, F.lit('"'))
