"""Times without a zone, all UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss"
# Fixed value: states in which an instance carries its stop time in the reason text.
ENDED_STATES = ("terminated", "stopped")


def iso_from_text(text: Column) -> Column:
    """ISO text of a date and time written with any of ``- : space`` between the digits."""
    digits = F.translate(text, "-: ", "")
    return F.date_format(F.to_timestamp_ntz(digits, F.lit("yyyyMMddHHmmss")), ISO)


def iso_millis(ts: Column) -> Column:
    """ISO text to the second, closed with ``.000Z``."""
    return F.concat(F.date_format(ts, ISO), F.lit(".000Z"))


def epoch_to_time(seconds: Column) -> Column:
    """Seconds since the epoch, with a fraction, as a UTC time without a zone."""
    micros = F.round(seconds * F.lit(1000000.0)).cast("long")
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def stop_time(state: Column, reason: Column, now: Column) -> Column:
    """Stop time of an instance as ISO text.

    An ended instance names it inside the first parentheses of the reason, as
    ``yyyy-MM-dd HH:mm:ss ZONE``; any other instance has run until ``now``.
    A reason without such text gives NULL.
    """
    inside = F.get(F.split(F.get(F.split(reason, r"\("), F.lit(1)), r"\)"), F.lit(0))
    words = F.split(F.btrim(inside), r"\s+")
    stopped = F.concat(F.get(words, F.lit(0)), F.lit("T"), F.get(words, F.lit(1)), F.lit(".000Z"))
    return F.when(state.isin(*ENDED_STATES), stopped).otherwise(iso_millis(now))


def iso_to_time(text: Column) -> Column:
    """Time without a zone from ISO text, with or without ``.000Z``."""
    return F.to_timestamp_ntz(F.substring(text, 1, 19), F.lit(ISO))


def hours_between(start: Column, stop: Column) -> Column:
    """Whole seconds from start to stop, in hours; the zone of the session does not matter."""
    def seconds(ts: Column) -> Column:
        since = ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        parts = [F.extract(F.lit(unit), since) * size for unit, size in (("DAY", 86400), ("HOUR", 3600), ("MINUTE", 60))]
        return sum(parts, F.floor(F.extract(F.lit("SECOND"), since))).cast("long")

    return (seconds(stop) - seconds(start)) / F.lit(3600.0)
