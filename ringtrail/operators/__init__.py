from ringtrail.operators.addresses import explode_addresses, without_address
from ringtrail.operators.parse import add_event_time, add_partition_columns, parse_cdr
from ringtrail.operators.pruning import only_wanted
from ringtrail.operators.sessions import distinct_sessions, newest_session, pick_latest
from ringtrail.operators.subscribers import identified, join_subscribers, unidentified

__all__ = [
    "add_event_time",
    "add_partition_columns",
    "distinct_sessions",
    "explode_addresses",
    "identified",
    "join_subscribers",
    "newest_session",
    "only_wanted",
    "parse_cdr",
    "pick_latest",
    "unidentified",
    "without_address",
]
