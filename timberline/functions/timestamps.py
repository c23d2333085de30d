"""Event times out of log lines. Formats without a zone are read as UTC, the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
DAYS = "(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)"


def rfc3339(line: Column) -> Column:
    token = F.split(line, " ", 2)[0]
    fits = (F.length(token) >= 20) & token.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:[.,]\d+)?(?:Z|[+-]\d\d:\d\d)$")
    return F.when(fits, F.try_to_timestamp(token))


def _fixed(line: Column, shape: str, length: int, pattern: str, start: int = 1) -> Column:
    text = F.substring(line, start, length)
    return F.when(text.rlike("^" + shape + "$"), F.try_to_timestamp(text, F.lit(pattern)))


def log4j(line: Column) -> Column:
    comma = _fixed(line, r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d,\d{3}", 23, "yyyy-MM-dd HH:mm:ss,SSS")
    return F.coalesce(comma, _fixed(line, r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{3}", 23, "yyyy-MM-dd HH:mm:ss.SSS"))


def sql_style(line: Column) -> Column:
    return _fixed(line, r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", 19, "yyyy-MM-dd HH:mm:ss")


def _two_digit_year(ts: Column) -> Column:
    """Two-digit years from 69 on lie in the last century."""
    return F.when(F.year(ts) >= 2069, ts - F.expr("INTERVAL '100' YEAR")).otherwise(ts)


def hdfs(line: Column) -> Column:
    return _two_digit_year(_fixed(line, r"\d{6} \d{6}", 13, "yyMMdd HHmmss"))


def spark_style(line: Column) -> Column:
    return _two_digit_year(_fixed(line, r"\d\d/\d\d/\d\d \d\d:\d\d:\d\d", 17, "yy/MM/dd HH:mm:ss"))


def apache(line: Column) -> Column:
    """Weekday, month, day, time and year behind the first character."""
    fits = F.substring(line, 2, 24).rlike(f"^{DAYS} {MONTHS} [0-9 ]\\d \\d\\d:\\d\\d:\\d\\d \\d{{4}}$")
    text = F.regexp_replace(F.substring(line, 6, 20), "^(...)  ", "$1 0")
    return F.when(fits, F.try_to_timestamp(text, F.lit("MMM dd HH:mm:ss yyyy")))


def syslog(line: Column, now: Column) -> Column:
    """Month, day and time; the year is that of ``now``, or the one before if that lies over a day ahead.

    The last day of February is the first of March in a year that hasn't got it.
    """
    text = F.substring(line, 1, 15)
    fits = text.rlike(f"^{MONTHS} [0-9 ]\\d \\d\\d:\\d\\d:\\d\\d$")
    padded = F.regexp_replace(text, "^(...)  ", "$1 0")
    leap = F.try_to_timestamp(F.concat(F.lit("2000 "), padded), F.lit("yyyy MMM dd HH:mm:ss"))  # a leap year has every day

    def at(year: Column) -> Column:
        first = F.make_timestamp(years=year, months=F.month(leap), days=F.lit(1), hours=F.hour(leap), mins=F.minute(leap), secs=F.second(leap))
        return first + F.make_dt_interval(F.dayofmonth(leap) - 1)

    this = at(F.year(now))
    return F.when(fits, F.when(this > now + F.expr("INTERVAL '24' HOUR"), at(F.year(now) - 1)).otherwise(this))


def parse_timestamp(line: Column, now: Column) -> Column:
    """The first format that fits, in the fixed order; null if none does."""
    return F.coalesce(rfc3339(line), log4j(line), sql_style(line), hdfs(line), spark_style(line), apache(line), syslog(line, now))
