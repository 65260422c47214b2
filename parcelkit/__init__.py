"""parcelkit: Spark-native mass-appraisal analytics.

Typed ingest of all-string landed files, core tables, bundle-sale removal,
value bins, latest-row selection, quantile statistics, page analytics,
random-forest valuation and map-tile assignment, each expressed as a
DataFrame plan that Catalyst optimises.
"""

from parcelkit.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
