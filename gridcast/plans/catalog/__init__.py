"""Every operator as a query over the driver's tables, most of them paired with equivalent SQL."""

from gridcast.plans.catalog.base import QUERIES, SQL
from gridcast.plans.catalog import calibration, cleaning, features, history, models, reports, scans, streams  # noqa: F401

__all__ = ["QUERIES", "SQL"]
