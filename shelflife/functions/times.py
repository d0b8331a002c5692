"""Time expressions.

All times are zone-less (``timestamp_ntz``): an offset in the text is dropped,
not applied.  Nothing here depends on the session time zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OFFSET = r"(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:[.,]\d+)?)?)?)?"
_CLOCK = r"(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?)?"
_ISO = rf"^(?:(\d{{4}})-(\d{{2}})-(\d{{2}})|(\d{{4}})(\d{{2}})(\d{{2}})){_CLOCK}{_OFFSET}$"
_ISO_PARTS = "$1$4-$2$5-$3$6 $7:$8:$9.$10"
_WEEK = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?(?=$|[T ])"
_ISO_PREFIX = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$"
_MAIL_DATE = (
    r"^(?:[A-Za-z]+,\s*)?(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{4}|\d{2})\s+"
    r"(\d{1,2}:\d{2}(?::\d{2})?).*$"
)
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
# The spellings that nearly all texts have.  They are read by one expression or by place; all
# others, and those of these that are no time, go through the general expressions.
_PLAIN_ISO = rf"^(\d{{4}}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(?:\.\d{{1,6}})?)(?:(?<=\.\d{{6}})\d+)?{_OFFSET}$"
_PLAIN_MAIL = r"^[A-Za-z]{3}, \d\d [A-Za-z]{3} \d{4} \d\d:\d\d:\d\d GMT$"


def at(moment: datetime) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def on(moment: datetime) -> Column:
    """The date literal of a moment."""
    return F.lit(moment.date())


def week_dates(text: Column) -> Column:
    """``2026-W12-2`` at the start of a text as a calendar date; other texts unchanged."""
    year, week, day = (F.regexp_extract(text, _WEEK, i) for i in (1, 2, 3))
    number = week.try_cast("int")
    first = F.date_trunc("week", F.make_date(year.try_cast("int"), F.lit(1), F.lit(4))).cast("date")
    monday = F.date_add(first, (number - 1) * 7)
    # A week belongs to the year of its Thursday.
    exists = number.between(1, 53) & (F.year(F.date_add(monday, 3)) == year.try_cast("int"))
    found = F.date_add(monday, F.coalesce(day.try_cast("int"), F.lit(1)) - 1)
    rest = F.regexp_replace(text, _WEEK, "")
    return F.when(
        text.rlike(_WEEK), F.when(exists, F.concat(found.cast("string"), rest))
    ).otherwise(text)


def parse_iso(text: Column) -> Column:
    """ISO 8601, extended, basic or by week, with optional fraction and offset.

    Other texts are tried by their first 19 characters.
    """
    plain = F.nullif(F.regexp_extract(text, _PLAIN_ISO, 1), F.lit(""))
    return F.coalesce(plain.try_cast("timestamp_ntz"), _parse_any_iso(text))


def _parse_any_iso(text: Column) -> Column:
    prefix = F.substring(text, 1, 19)
    by_day = week_dates(text)
    parts = F.regexp_replace(F.regexp_replace(by_day, _ISO, _ISO_PARTS), "[ :.]+$", "")
    return F.when(by_day.rlike(_ISO), parts.try_cast("timestamp_ntz")).when(
        prefix.rlike(_ISO_PREFIX), prefix.try_cast("timestamp_ntz")
    )


def parse_mail_date(text: Column) -> Column:
    """The mail form ``Tue, 17 Mar 2026 12:00:00 GMT``; weekday and zone are ignored.

    Years of two digits are 1969 to 2068.
    """
    day, name, year, clock = (F.regexp_extract(text, _MAIL_DATE, i) for i in (1, 2, 3, 4))
    century = F.when(year > "68", "19").otherwise("20")
    whole_year = F.when(F.length(year) == 2, F.concat(century, year)).otherwise(year)
    places = [F.substring(text, at, n) for at, n in ((6, 2), (9, 3), (13, 4), (18, 8))]
    return F.when(text.rlike(_PLAIN_MAIL), _stamp(*places)).when(
        text.rlike(_MAIL_DATE), _stamp(day, name, whole_year, clock)
    )


def _stamp(day: Column, month_name: Column, year: Column, clock: Column) -> Column:
    name_at = F.position(F.lower(month_name), F.lit(_MONTHS))
    month = F.when(name_at % 3 == 1, (name_at + 2) / 3).cast("int")
    stamp = F.concat(year, F.lit("-"), month.cast("string"), F.lit("-"), day, F.lit(" "), clock)
    return stamp.try_cast("timestamp_ntz")


def parse_any(text: Column) -> Column:
    """ISO 8601 as in :func:`parse_iso`, else the mail form: the first begins with four digits, the other never does."""
    return F.when(text.rlike(r"^\d{4}"), parse_iso(text)).otherwise(parse_mail_date(text))


def plus_days(moment: Column, days: Column) -> Column:
    return moment + F.make_dt_interval(days)


def whole_days_between(start: Column, end: Column) -> Column:
    """Whole 24-hour days from start to end, rounded down also below zero."""
    calendar_days = F.datediff(end, start)
    return F.when(plus_days(start, calendar_days) > end, calendar_days - 1).otherwise(calendar_days)


def calendar(spark: SparkSession, as_of: datetime, lookback_days: int, include_today: bool) -> DataFrame:
    """One row per day of the lookback window, oldest first."""
    first = as_of.date() - timedelta(days=lookback_days)
    days = lookback_days + (1 if include_today else 0)
    return spark.range(0, days, 1, 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("event_date")
    )
