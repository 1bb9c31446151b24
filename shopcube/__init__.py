"""shopcube: a PySpark-native shop-analytics warehouse.

Star schema builders, analytical views, daily marts, KPI-feed cleaning,
idempotent upserts, data-quality checks and Structured Streaming jobs,
all expressed as DataFrame -> DataFrame functions so Catalyst plans them.
"""

from shopcube.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
