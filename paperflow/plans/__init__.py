"""Ready-made jobs over the driver's tables, each with an equivalent SQL text where SQL can say it."""

from . import calendars, classification, enrichment, gates, markup, records, rollups, scans, streams  # noqa: F401
from .catalog import JOBS, SQL


def jobs():
    return dict(JOBS)


def sql_twins():
    return dict(SQL)
