"""Operators: change-window filters and the six save modes."""

from .filters import filter_daily, filter_document_daily, filter_range
from .merge import SaveMode, dedup_incoming, merge_state
