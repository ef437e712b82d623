"""Column-level helpers (all JVM-side built-ins, no Python UDFs)."""

from rillflow.functions.hashing import partition_of
from rillflow.functions.jsonio import decode_json, encode_json, lenient_int, parse_json
from rillflow.functions.text import java_split_words, upper_all
from rillflow.functions.time import (
    EPOCH_ZERO,
    as_event_time,
    as_wall_clock,
    epoch_millis,
    format_iso_millis,
    money,
    parse_iso,
)

__all__ = [
    "partition_of", "decode_json", "encode_json", "lenient_int", "parse_json", "java_split_words",
    "upper_all", "EPOCH_ZERO", "as_event_time", "as_wall_clock", "epoch_millis",
    "format_iso_millis", "money", "parse_iso",
]
