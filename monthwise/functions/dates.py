"""Month formats (O16) and date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_label(date) -> Column:
    """``'June 2001'``: month name, a space, the four-digit year."""
    return F.date_format(_col(date), "MMMM yyyy")


def month_date(date) -> Column:
    """First day of the date's month, as a DATE."""
    return F.trunc(_col(date), "MM")


def days_between(start, end) -> Column:
    """Whole days from ``start`` to ``end`` (``DATEDIFF(DD, start, end)``)."""
    return F.datediff(_col(end), _col(start))
