"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions import text


def in_catchment(allowed: tuple[str, ...], gazetteer: tuple[str, ...]) -> Column:
    """No filter keeps all; online rows stay; a stated suburb decides; else any allowed name anywhere in the row's text."""
    if not allowed:
        return F.lit(True)
    suburb = text.extract_suburb(F.col("address"), gazetteer)
    blob = F.lower(F.concat_ws(" ", "name", "location", "address", "description"))
    anywhere = F.lit(False)
    for name in allowed:
        anywhere = anywhere | F.contains(blob, F.lit(name.lower()))
    return text.is_online(F.col("location")) | F.when(suburb != "", suburb.isin(*allowed)).otherwise(anywhere)


def prune_old(rows: DataFrame, ts_col: str, today: str, days: int = 90) -> DataFrame:
    """Rows that began before `days` ago go; undated rows stay."""
    floor = F.date_sub(F.lit(today).cast("date"), days).cast("timestamp_ntz")
    return rows.where(F.col(ts_col).isNull() | (F.col(ts_col) >= floor))
