"""DT1-DT12: date parsing and time arithmetic, all native.

Per-source post dates (DT1-DT4) use `try_to_timestamp`, so a bad value is NULL (and
the row goes to quarantine) instead of failing the job. A date without a year takes
the snapshot's year, or the year before when that would put it after the snapshot
(the reference used the wall clock; see SURVEY D11). Two-digit years follow
Python's pivot: 69..99 -> 19xx, 00..68 -> 20xx.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four site layouts (Spark datetime patterns).
DC_LAYOUT = "yyyy.M.d H:m:s"  # 2024.08.13 15:40:00 / 08.13 15:40:00
NAVER_LAYOUT = "yyyy.M.d. H:m"  # 2024.07.05. 21:54 / 07.05. 21:54
BOBAE_LAYOUT = "yy.M.d H:m"  # 24.08.20  13:05
CLIEN_LAYOUT = "yyyy-M-d H:m:s"  # 2024-08-20  13:05:09
OUT_LAYOUT = "yyyy-MM-dd HH:mm:ss"
LISTING_BOBAE = "yy. M. d"  # 24. 08. 20
LISTING_CLIEN = "yyyy-M-d H:m:s"
LISTING_NAVER = "yyyy.M.d."
LISTING_NAVER_GATE = r"^\d{4}.\d{2}.\d{2}.$"
TIME_OF_DAY = r"^([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d)?$"
TWO_DIGIT_PIVOT = 69
SEOUL = "Asia/Seoul"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _squash(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


LEAP_DAY = r"^0?2\.29\b"


def _with_snapshot_year(x: Column, layout: str, snapshot: Column) -> Column:
    """`x` with the newest year that puts it at or before the snapshot: the snapshot's year,
    the one before, and for a Feb 29 the last leap year (8 years back at most)."""

    def in_year(back: int) -> Column:
        t = F.try_to_timestamp(F.concat((F.year(snapshot) - back).cast("string"), F.lit("."), x), F.lit(layout))
        return F.when(t <= snapshot, t)

    leap = F.when(x.rlike(LEAP_DAY), F.coalesce(*[in_year(k) for k in range(2, 9)]))
    return F.coalesce(in_year(0), in_year(1), leap)


def parse_dc(c, snapshot: Column) -> Column:
    """DT1."""
    x = _squash(_c(c))
    return F.coalesce(F.try_to_timestamp(x, F.lit(DC_LAYOUT)), _with_snapshot_year(x, DC_LAYOUT, snapshot))


def parse_naver(c, snapshot: Column) -> Column:
    """DT2."""
    x = _squash(_c(c))
    return F.coalesce(F.try_to_timestamp(x, F.lit(NAVER_LAYOUT)), _with_snapshot_year(x, NAVER_LAYOUT, snapshot))


def pivot_two_digit_year(t: Column, yy: Column) -> Column:
    return F.when(yy >= TWO_DIGIT_PIVOT, F.add_months(F.to_date(t), -1200).cast("timestamp") + (t - F.date_trunc("day", t))).otherwise(t)


def parse_bobae(c) -> Column:
    """DT3: two-digit year with the 69 pivot; any run of blanks between date and time."""
    x = _squash(_c(c))
    t = F.try_to_timestamp(x, F.lit(BOBAE_LAYOUT))
    yy = F.regexp_extract(x, r"^(\d{2})\.", 1).try_cast("int")
    return pivot_two_digit_year(t, yy)


def parse_clien(c) -> Column:
    """DT4."""
    return F.try_to_timestamp(_squash(_c(c)), F.lit(CLIEN_LAYOUT))


def parse_post_date(c, source: Column, snapshot: Column) -> Column:
    """P12 dispatch over the four layouts; unknown source -> NULL (quarantine)."""
    return (
        F.when(source.isin("dc", "dcinside"), parse_dc(c, snapshot))
        .when(source == "naver", parse_naver(c, snapshot))
        .when(source == "bobae", parse_bobae(c))
        .when(source == "clien", parse_clien(c))
    )


def format_ts(c) -> Column:
    """DT5."""
    return F.date_format(_c(c), OUT_LAYOUT)


def to_local(c, zone: str = SEOUL) -> Column:
    """DT6: UTC -> local wall time of `zone`."""
    return F.from_utc_timestamp(_c(c), zone)


def look_back_date(start, period_days: int) -> Column:
    """DT12: start date - period."""
    return F.date_sub(F.to_date(_c(start)), period_days)


def parse_listing_date(c, source: Column, snapshot: Column) -> Column:
    """DT11: listing dates; naver values must pass the gate regex, or be a time of day
    (posted today), which takes the snapshot date (SURVEY D24). Anything else is NULL."""
    x = F.trim(_c(c))
    bobae = F.to_date(pivot_two_digit_year(F.try_to_timestamp(x, F.lit(LISTING_BOBAE)), F.regexp_extract(x, r"^(\d{2})\.", 1).try_cast("int")))
    naver = F.when(x.rlike(LISTING_NAVER_GATE), F.to_date(F.try_to_timestamp(x, F.lit(LISTING_NAVER)))).when(x.rlike(TIME_OF_DAY), F.to_date(snapshot))
    clien = F.to_date(F.try_to_timestamp(x, F.lit(LISTING_CLIEN)))
    return F.when(source == "bobae", bobae).when(source == "naver", naver).when(source == "clien", clien)


def in_listing_window(d: Column, start: Column, period_days: int) -> Column:
    """Start - (period + 1) days <= d <= start (date comparison for all sources)."""
    s = F.to_date(start)
    return (d >= F.date_sub(s, period_days + 1)) & (d <= s)
