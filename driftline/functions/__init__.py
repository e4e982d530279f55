from driftline.functions.route import topic_to_table, normalize_location
from driftline.functions.json import (
    decode_utf8, json_kind, is_json_null, is_object, is_array, blank_text, jvm_number_text,
)

__all__ = ["topic_to_table", "normalize_location", "decode_utf8", "json_kind", "is_json_null",
           "is_object", "is_array", "blank_text", "jvm_number_text"]
