"""hausprep: Spark-native cleaning, classification, profiling and movement
of semi-structured listing data.

The most used entry points are re-exported here; everything else lives in
``functions``, ``operators``, ``sources``, ``sinks`` and ``plans``.
"""

__version__ = "0.1.0"

from hausprep.plans.daily import daily_run  # noqa: E402
from hausprep.plans.listings import (  # noqa: E402
    ListingColumns,
    ListingOutput,
    clean_listings,
    finalize_only,
)
from hausprep.plans.quality import profile_table, quality_report, stage_metrics  # noqa: E402
from hausprep.session import build_session, materialize  # noqa: E402

__all__ = [
    "ListingColumns", "ListingOutput", "build_session", "clean_listings", "daily_run",
    "finalize_only", "materialize", "profile_table", "quality_report", "stage_metrics",
]
