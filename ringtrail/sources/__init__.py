from ringtrail.sources.dictionaries import read_dictionary, session_addresses, shape_dictionary
from ringtrail.sources.feeds import kafka_options, open_feed

__all__ = [
    "kafka_options",
    "open_feed",
    "read_dictionary",
    "session_addresses",
    "shape_dictionary",
]
