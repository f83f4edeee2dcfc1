from linkmart.functions.json_ops import (
    as_variant, canonical_json, is_truthy, json_array_text, json_kind, json_path,
    json_text, json_value,
)
from linkmart.functions.scalars import (
    changed, parse_long_date, surrogate_key, url_tail_regex, url_tail_split,
)

__all__ = [
    "as_variant", "canonical_json", "is_truthy", "json_array_text", "json_kind", "json_path",
    "json_text", "json_value", "changed", "parse_long_date", "surrogate_key",
    "url_tail_regex", "url_tail_split",
]
