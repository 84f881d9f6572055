"""Epoch seconds, and the days and hours derived from them, without a time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last second of the years 1 to 9999.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def epoch_seconds(epoch: Column) -> Column:
    """Whole seconds; null outside the years 1 to 9999."""
    seconds = epoch.cast("bigint")
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), seconds)


def epoch_ts(epoch: Column) -> Column:
    """Timestamp of whole epoch seconds; null outside the years 1 to 9999."""
    return F.timestamp_seconds(epoch_seconds(epoch))


def epoch_day(epoch: Column) -> Column:
    """UTC day of epoch seconds, whatever the session's zone."""
    seconds = epoch_seconds(epoch)
    days = (seconds - F.pmod(seconds, F.lit(86_400))) / 86_400
    return F.date_from_unix_date(days.cast("int"))


def utc_now() -> Column:
    """The current time as text, in UTC whatever the session's zone."""
    micros = F.unix_micros(F.current_timestamp())
    return utc_text(micros)


def utc_text(micros: Column) -> Column:
    """Epoch microseconds as text such as ``2024-01-15T08:30:00.000001``, in UTC.

    Put together from numbers: a time shifted by the zone's offset would be wrong in the
    hours that the zone skips or repeats.
    """
    seconds = F.floor(micros / 1_000_000).cast("bigint")
    of_day = F.pmod(seconds, F.lit(86_400)).cast("int")
    clock = F.format_string(
        "T%02d:%02d:%02d.%06d",
        F.floor(of_day / 3_600).cast("int"),
        F.floor(of_day / 60).cast("int") % 60,
        of_day % 60,
        F.pmod(micros, F.lit(1_000_000)).cast("int"),
    )
    return F.concat(epoch_day(seconds).cast("string"), clock)


def hour_keys(epoch: Column) -> dict[str, Column]:
    """Text columns year, month, day and hour (UTC), zero padded."""
    day = epoch_day(epoch)
    hour = F.floor(F.pmod(epoch_seconds(epoch), F.lit(86_400)) / 3_600)
    parts = {
        "year": (F.year(day), 4),
        "month": (F.month(day), 2),
        "day": (F.dayofmonth(day), 2),
        "hour": (hour, 2),
    }
    return {
        key: F.lpad(value.cast("string"), width, "0") for key, (value, width) in parts.items()
    }


def hour_path(epoch: Column) -> Column:
    """Partition folder of an hour, ``year=Y/month=MM/day=DD/hour=HH``."""
    keys = hour_keys(epoch)
    parts = [F.concat(F.lit(f"{key}="), value) for key, value in keys.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = F.concat(whole, F.lit("/"), part)
    return whole


def object_path(epoch: Column, question_id: Column) -> Column:
    """Object name of one question within its hour.

    ``format_string`` widens ids below eight digits and keeps longer ones
    whole, where ``lpad`` would cut them. Null without a time.
    """
    return F.concat(
        hour_path(epoch), F.format_string("/part-%08d.parquet", question_id)
    )
