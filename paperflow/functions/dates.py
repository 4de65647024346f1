"""Date labels.  All of them take DATE columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V


def listing_label(d: Column) -> Column:
    """``Mon, 1 Jun 2026``: the day is not padded."""
    return F.date_format(d, "EEE, d MMM yyyy")


def feed_stamp(d: Column, hour: int = V.FEED_HOUR, zone: str = V.FEED_ZONE) -> Column:
    """RFC-822 stamp pinned to one hour of the feed's own zone."""
    return F.concat(F.date_format(d, "EEE, dd MMM yyyy"), F.lit(f" {hour:02d}:00:00 {zone}"))


def day_label(d: Column, names: tuple[str, ...] = V.DAYS_LOCAL) -> Column:
    """ISO date and weekday name; ``names`` starts on Monday."""
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.weekday(d) + 1)
    return F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" ("), name, F.lit(")"))


def iso_week(d: Column) -> Column:
    """``2026-W53``: ISO year and ISO week, which differ from the calendar year around New Year."""
    return F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), d), F.weekofyear(d))


def review_week_label(d: Column) -> Column:
    """A weekly published on Monday reviews the Monday-to-Friday before it."""
    monday, friday = F.date_sub(d, 7), F.date_sub(d, 3)
    return F.concat(iso_week(monday), F.lit(" · "), F.date_format(monday, "MM-dd"),
                    F.lit(" ~ "), F.date_format(friday, "MM-dd"))


def is_weekend(d: Column) -> Column:
    return F.weekday(d) >= 5
