"""Text forms of timestamps in JSON documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def _body(ts: Column, fraction: bool) -> Column:
    plain = F.date_format(ts, _SECONDS)
    if not fraction:
        return plain
    exact = F.date_trunc("second", ts) == ts.cast("timestamp")
    return F.when(exact, plain).otherwise(F.date_format(ts, _SECONDS + ".SSSSSS"))


def iso_offset(ts: Column) -> Column:
    """A zoned timestamp with its offset written out (session time zone UTC: ``+00:00``)."""
    return F.concat(_body(ts, True), F.date_format(ts, "xxx"))


def iso_naive(ts: Column) -> Column:
    """A timestamp without zone."""
    return _body(ts, True)


def iso_utc(ts: Column, fraction: bool = True) -> Column:
    """UTC written as ``Z``, with or without the fraction of a second."""
    return F.concat(_body(ts, fraction), F.lit("Z"))
