"""cardsentry: a Spark-native daily fraud-report pipeline.

Daily drops of card operations, passport blacklists and terminal lists are
ingested as DataFrame jobs, kept as versioned dimensions, joined into
enriched operations and screened by five detections whose hits accumulate
in a report mart partitioned by report date.
"""

from cardsentry.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
