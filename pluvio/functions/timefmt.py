"""Time scalars (C4-C7): ``yyyyMMddHH`` stamps, epoch milliseconds, labels.

All patterns are fixed values that must equal the reference's formats.  Every
expression here works on epoch seconds and dates, never on the session's
clock, so results are UTC whatever ``spark.sql.session.timeZone`` says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats used by the reference (Python strftime -> Spark pattern).
STAMP = "yyyyMMddHH"            # %Y%m%d%H  file names, CSV columns, state file
AXIS_ORIGIN = "yyyy-MM-dd HH:00:00"  # %Y-%m-%d %H:00:00  time-axis units
HOUR = "HH"                     # %H        cycle hour in request URLs
DAY = "yyyyMMdd"                # %Y%m%d    cycle day in request URLs
LABEL = "MMM dd, hha 'UTC'"     # %b %d, %I%p UTC  cycle label


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_stamp(x) -> Column:
    """C4: ``yyyyMMddHH`` (int or string) -> timestamp; null when it is no such stamp."""
    s = _c(x).cast("string")
    hour = F.substring(s, 9, 2).try_cast("int")
    ok = s.rlike(r"^[0-9]{10}$") & (hour < 24)
    date = F.concat(F.substring(s, 1, 4), F.lit("-"), F.substring(s, 5, 2), F.lit("-"), F.substring(s, 7, 2))
    day = F.unix_date(F.when(ok, date).try_cast("date"))
    return F.timestamp_seconds(day.cast("long") * 86400 + hour * 3600)


def parse_stamp_number(x) -> Column:
    """``parse_stamp`` of a whole number, without text: what a stored table's cycle
    is read by, in every row."""
    n = _c(x).cast("long")
    part = lambda k: F.floor(n / k) % 100
    hour = n % 100
    ok = n.between(1_000_000_000, 9_999_999_999) & (hour < 24)
    zero = F.lit(0)
    at = F.try_make_timestamp_ntz(F.when(ok, F.floor(n / 1_000_000)).cast("int"), part(10_000).cast("int"), part(100).cast("int"), zero, zero, zero)
    return F.timestamp_seconds(F.unix_date(at.cast("date")).cast("long") * 86400 + hour * 3600)


def utc_day(ts) -> Column:
    """The UTC date of a timestamp."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(_c(ts)) / 86400).cast("int"))


def utc_hour(ts) -> Column:
    """The UTC hour of a timestamp, 0 to 23."""
    return F.floor(F.pmod(F.unix_seconds(_c(ts)), F.lit(86400)) / 3600).cast("int")


def _two(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def to_stamp(ts) -> Column:
    """Timestamp -> ``yyyyMMddHH`` as bigint (the reference CSV form)."""
    return fmt(ts, STAMP).cast("bigint")


def fmt(ts, pattern: str) -> Column:
    """Timestamp -> text in one of the patterns above."""
    day, hour = utc_day(ts), utc_hour(ts)
    h12 = _two(F.pmod(hour + 11, F.lit(12)) + 1)
    forms = {
        # years of four digits as a number, which costs half as much in every row written
        STAMP: lambda: F.when(F.year(day).between(1000, 9999),
                              (F.year(day).cast("long") * 1_000_000 + F.month(day) * 10_000 + F.dayofmonth(day) * 100 + hour).cast("string"))
        .otherwise(F.concat(F.date_format(day, DAY), _two(hour))),
        AXIS_ORIGIN: lambda: F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), _two(hour), F.lit(":00:00")),
        HOUR: lambda: _two(hour),
        DAY: lambda: F.date_format(day, DAY),
        LABEL: lambda: F.concat(F.date_format(day, "MMM dd"), F.lit(", "), h12,
                                F.when(hour < 12, F.lit("AM")).otherwise(F.lit("PM")), F.lit(" UTC")),
    }
    return forms[pattern]()


def epoch_ms(ts) -> Column:
    """UTC epoch milliseconds, as the chart series uses."""
    return F.unix_millis(_c(ts))


def from_epoch_s(s) -> Column:
    return F.timestamp_seconds(_c(s))


def cycle_label(display_name, ts) -> Column:
    """``<NAME> data from Jun 21, 12PM UTC`` or ``No <NAME> Timestamp Detected``."""
    name = _c(display_name)
    return F.when(_c(ts).isNull(),
                  F.concat(F.lit("No "), name, F.lit(" Timestamp Detected"))) \
        .otherwise(F.concat(name, F.lit(" data from "), fmt(ts, LABEL)))


def add_hours(ts, hours) -> Column:
    """``ts + hours`` as an interval (no epoch round-trips)."""
    return _c(ts) + F.make_dt_interval(F.lit(0), _c(hours).cast("int"))
