"""Subscriber-identity enrichment of call-detail records, and compaction of the result, on Spark."""

from ringtrail.plans.compact import compact_copy, compact_move
from ringtrail.plans.enrich import enrich, enrich_by_imsi, enrich_by_ip

__all__ = ["compact_copy", "compact_move", "enrich", "enrich_by_imsi", "enrich_by_ip"]
