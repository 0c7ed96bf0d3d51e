"""Key-column conventions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DayTimeIntervalType


def field_keys(df: DataFrame, with_param: bool = True) -> list[str]:
    """Identity of one pixel series: run, [param], [model], [member], iy, ix."""
    lead = ["run", "param", "model", "member"] if with_param else ["run", "model", "member"]
    return [c for c in lead if c in df.columns] + ["iy", "ix"]


def step_hours(df: DataFrame, name: str = "step") -> Column:
    """Forecast hour as DOUBLE; a day-time interval step is divided by one hour."""
    if isinstance(df.schema[name].dataType, DayTimeIntervalType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.unix_micros((epoch + F.col(name)).cast("timestamp")) / F.lit(3.6e9)
    return F.col(name).cast("double")
