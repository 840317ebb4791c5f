"""Mart compositions, publishing and the query catalogue."""

from stellate.plans import mart
from stellate.plans.build import CalendarWindow, build_mart
from stellate.plans.publish import MART_VIEWS, Published, create_view, publish, read_back, sample_view, write_table

__all__ = [
    "MART_VIEWS",
    "Published",
    "CalendarWindow",
    "build_mart",
    "create_view",
    "mart",
    "publish",
    "read_back",
    "sample_view",
    "write_table",
]
