from ringtrail.streaming.enrichment import start_enrichment
from ringtrail.streaming.progress import ProgressLog, latest_progress
from ringtrail.streaming.snapshots import Snapshot
from ringtrail.streaming.supervision import run_together

__all__ = ["ProgressLog", "Snapshot", "latest_progress", "run_together", "start_enrichment"]
