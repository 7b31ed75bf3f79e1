"""Composed jobs and layout control (the query catalog lives in ``catalog``)."""

from .jobs import changed_rows, sync, sync_to_jdbc, sync_to_path
from .layout import cap_partitions, hash_layout, write_hash_layout
