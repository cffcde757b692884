from ringtrail.functions.casts import EPOCH_UNITS, from_epoch, parse_as, to_long
from ringtrail.functions.identity import has_usable_imsi, lacks_usable_imsi
from ringtrail.functions.sizing import file_count

__all__ = [
    "EPOCH_UNITS",
    "file_count",
    "from_epoch",
    "has_usable_imsi",
    "lacks_usable_imsi",
    "parse_as",
    "to_long",
]
