"""Every operator run on the driver's tables, each with its SQL counterpart.

``QUERIES`` maps a name to ``(spark, folder) -> DataFrame``, ``SQL`` to the equivalent statement. In
results dates are text, decimals doubles rounded to six places, so that engines print them alike.
"""

from driver_queries.registry import QUERIES, SQL
from driver_queries import changes, feed, incremental, prices, quality, silver, star  # noqa: F401  (they register themselves)

__all__ = ["QUERIES", "SQL"]
