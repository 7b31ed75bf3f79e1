"""Column functions: prefixed ids and JSON records."""

from .ids import ENTITY_PREFIXES, entity_id, with_entity_id
from .records import convert_record, decode_url, read_encoded_json, read_json
