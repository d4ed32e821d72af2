"""Epoch-aligned tumbling windows (W8) and id de-duplication with expiry."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEEN_ID_RETENTION = "30 days"      # fixed value: expiry of recorded ids

_UNITS = {"s": "seconds", "m": "minutes", "h": "hours"}


def duration(spec: str) -> str:
    """``10s`` / ``5m`` / ``1h`` (the job option format) -> Spark interval text."""
    m = re.fullmatch(r"\s*(\d+)\s*([smh])\s*", spec)
    if not m:
        return spec
    return f"{m.group(1)} {_UNITS[m.group(2)]}"


_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def size_micros(spec: str) -> int:
    """``10s`` / ``5m`` / ``2h`` / ``10 seconds`` -> microseconds."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+)\s*", spec.lower())
    if not m:
        raise ValueError(f"bad window size: {spec}")
    unit = {"s": "second", "m": "minute", "h": "hour", "d": "day"}.get(m.group(2), m.group(2).rstrip("s"))
    return int(m.group(1)) * _MICROS[unit]


def window_start(ts: Column, size: str) -> Column:
    """Start of the epoch-aligned tumbling window holding ``ts``:
    ``start = ts - (ts + size) mod size`` (same as ``window(ts, size).start``, and usable
    several times in one projection)."""
    us = F.unix_micros(ts)
    n = F.lit(size_micros(size))
    return F.timestamp_micros(us - F.pmod(us + n, n))


def dedup_ids(df: DataFrame, id_col: str = "id", ts_col: str = "created_at",
              now=None, retention: str = SEEN_ID_RETENTION) -> DataFrame:
    """W11 (batch): one row per id among ids recorded within the retention period."""
    now_c = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    live = df.where(F.col(ts_col) >= now_c - F.expr(f"INTERVAL {retention}"))
    return live.groupBy(id_col).agg(F.min(ts_col).alias(ts_col))


def dedup_ids_stream(df: DataFrame, id_col: str = "id", ts_col: str = "created_at",
                     retention: str = SEEN_ID_RETENTION) -> DataFrame:
    """W11 (stream): ids de-duplicated while the watermark is within the retention."""
    return df.withWatermark(ts_col, retention).dropDuplicatesWithinWatermark([id_col])
