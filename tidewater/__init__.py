"""tidewater - table-sync operators on Spark DataFrames.

Keep a changed window of a table, mint ids, parse JSON columns and merge the
result into a target under one of six save modes, as plain DataFrame plans.
Submodules hold the sources and sinks; the names below are the everyday API.
"""

from .functions.ids import entity_id, with_entity_id
from .functions.records import convert_record, read_encoded_json, read_json
from .operators.filters import filter_daily, filter_document_daily, filter_range
from .operators.merge import SaveMode, dedup_incoming, merge_state
from .plans.jobs import changed_rows, sync, sync_to_jdbc, sync_to_path
from .sources.keys import key_scan, keyed_view

__all__ = [
    "SaveMode",
    "changed_rows",
    "convert_record",
    "dedup_incoming",
    "entity_id",
    "filter_daily",
    "filter_document_daily",
    "filter_range",
    "key_scan",
    "keyed_view",
    "merge_state",
    "read_encoded_json",
    "read_json",
    "sync",
    "sync_to_jdbc",
    "sync_to_path",
    "with_entity_id",
]
