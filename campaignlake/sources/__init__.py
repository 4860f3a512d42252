"""Sources (landed JSON records, the driver's tables) and sinks."""

from .fixtures import campaign_log, table
from .records import parse_records, read_records, record_struct, to_records

__all__ = ["campaign_log", "table", "parse_records", "read_records", "record_struct", "to_records"]
