"""Monthly lakes of dated records on Spark: load, check, deduplicate, serve."""

from monthlake.months import BatchMonth
from monthlake.zones import Zones

__all__ = ["BatchMonth", "Zones"]
