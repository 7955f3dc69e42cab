"""Milliseconds, clocks and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_ms(seconds: Column) -> Column:
    """Seconds to whole milliseconds, half to even."""
    return F.rint(seconds * 1000).cast("bigint")


def to_seconds(ms: Column) -> Column:
    return ms / F.lit(1000.0)


def exact(columns: list[str], side: str) -> Column:
    """The start or end in seconds as the source had it if the rows carry it (start_s, end_s), else from milliseconds."""
    return F.col(f"{side}_s") if f"{side}_s" in columns else to_seconds(F.col(f"{side}_ms"))


def clock(ms: Column, mark: str = ".") -> Column:
    """HH:MM:SS and milliseconds after the mark; times before 0 show as 0."""
    t = F.greatest(ms.cast("bigint"), F.lit(0).cast("bigint"))
    part = lambda unit, of: F.floor(t / unit).cast("bigint") % of
    return F.format_string(f"%02d:%02d:%02d{mark}%03d", F.floor(t / 3_600_000).cast("bigint"), part(60_000, 60), part(1000, 60), t % 1000)


def srt_clock(ms: Column) -> Column:
    return clock(ms, ",")


def fixed3(x: Column) -> Column:
    """A number with three decimals."""
    return F.format_string("%.3f", x)


def speaker_label(n: Column) -> Column:
    return F.format_string("SPK%02d", n.cast("int"))
