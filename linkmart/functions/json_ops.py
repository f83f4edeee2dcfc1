"""JSON access on payload text or VARIANT columns.

All helpers return ``Column`` expressions, so they stay inside whole-stage codegen.
Payloads are stored as canonical JSON text; they are parsed to VARIANT only where a
JSON *kind* (string vs number vs null) matters.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def json_path(key: str) -> str:
    if _IDENT.match(key):
        return f"$.{key}"
    return "$['" + key.replace("'", "\\'") + "']"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A VARIANT holds decimals of up to 38 digits exactly and reads numbers with an exponent as
# doubles. Such texts are rewritten before they are parsed: a number with an exponent in
# plain digits, and one of more digits as a string behind a mark that is taken off again.
_MARK = "\ue000#"
# The look for them starts at a digit, so that texts without one cost little.
_UNUSUAL = r"[0-9](?:[eE][+-]?[0-9]|[0-9.]{38})"
_TOKENS = r'"(?:[^"\\]|\\.)*+"|-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|[^"0-9-]++|.'
_NUMBER = r"^(-?)([0-9]+)(?:\.([0-9]+))?(?:[eE]([+-]?[0-9]{1,9}))?$"
#: Numbers with a larger exponent stay as they are written.
_MAX_EXPONENT = 400


def _plain(token: Column) -> Column:
    """The number ``token`` without exponent and idle zeros; a longer one as a marked string."""
    part = lambda i: F.regexp_extract(token, _NUMBER, i)
    e = F.coalesce(part(4).try_cast("int"), F.lit(0))
    digits, whole = F.concat(part(2), part(3)), F.length(part(2)) + e
    left = F.when(whole <= 0, F.lit("0")).when(whole >= F.length(digits), F.rpad(digits, whole, "0")) \
        .otherwise(F.substring(digits, F.lit(1), whole))
    right = F.when(whole >= F.length(digits), F.lit("")).when(whole <= 0, F.concat(F.repeat(F.lit("0"), -whole), digits)) \
        .otherwise(F.substring(digits, whole + 1, F.length(digits)))
    left, right = F.regexp_replace(left, "^0+(?=.)", ""), F.regexp_replace(right, "0+$", "")
    sign = F.when((left == "0") & (right == ""), F.lit("")).otherwise(part(1))
    number = F.concat(sign, left, F.when(right != "", F.concat(F.lit("."), right)).otherwise(F.lit("")))
    mark = lambda x: F.concat(F.lit(f'"{_MARK}'), x, F.lit('"'))
    short = F.length(F.concat(F.when(left == "0", F.lit("")).otherwise(left), right)) <= 38
    return F.when(F.abs(e) > _MAX_EXPONENT, mark(token)).when(short, number).otherwise(mark(number))


def exact_numbers(text) -> Column:
    """JSON text whose numbers, outside strings, a VARIANT holds exactly (see ``variant_json``);
    other texts pass through after one look."""
    t = _col(text)
    tokens = F.regexp_extract_all(t, F.lit(f"(?s){_TOKENS}"), F.lit(0))
    exact = F.array_join(F.transform(tokens, lambda x: F.when(x.rlike(_NUMBER) & x.rlike(_UNUSUAL), _plain(x)).otherwise(x)), "")
    return F.when(t.rlike(_UNUSUAL) & ~t.contains(_MARK[0]), exact).otherwise(t)


def variant_json(v) -> Column:
    """JSON text of a VARIANT parsed from ``exact_numbers``: keys sorted, marks taken off."""
    text = F.to_json(_col(v))
    return F.when(text.contains(_MARK), F.regexp_replace(text, f'"{_MARK}([-+0-9.eE]+)"', "$1")).otherwise(text)


def as_variant(c) -> Column:
    """Parse JSON text to VARIANT (NULL when unparseable); VARIANT input passes through."""
    return F.try_parse_json(_col(c))


def json_text(v, key: str) -> Column:
    """``payload->>key``: scalars as text, objects/arrays as JSON text, JSON null or
    missing key -> NULL. ``v`` must be a VARIANT column (see ``as_variant``)."""
    return F.try_variant_get(_col(v), json_path(key), "string")


def json_value(v, key: str) -> Column:
    """``payload->key`` as JSON text: a JSON null stays the text ``null``, a missing key
    is SQL NULL."""
    return F.to_json(F.try_variant_get(_col(v), json_path(key), "variant"))


def canonical_json(payload) -> Column:
    """Key-sorted, whitespace-free JSON text; equal JSON documents give equal text, however
    their numbers are written (``100``, ``1e2``, ``100.0``). NULL for unparseable text
    (including duplicate keys)."""
    return variant_json(F.try_parse_json(exact_numbers(payload)))


def json_kind(v) -> Column:
    """One of object, array, string, number, boolean, null; SQL NULL when absent."""
    t = F.schema_of_variant(_col(v))
    return (
        F.when(t.isNull(), F.lit(None).cast("string"))
        .when(t.startswith("OBJECT"), "object")
        .when(t.startswith("ARRAY"), "array")
        .when(t == "STRING", "string")
        .when(t == "BOOLEAN", "boolean")
        .when(t == "VOID", "null")
        .otherwise("number")
    )


def is_truthy(v) -> Column:
    """Python truthiness of a JSON value: null, "", 0, false, [], {} and absent are false."""
    v = _col(v)
    kind = json_kind(v)
    return (
        F.when(kind.isNull() | (kind == "null"), F.lit(False))
        .when(kind == "string", F.length(F.try_variant_get(v, "$", "string")) > 0)
        .when(kind == "number", F.try_variant_get(v, "$", "double") != 0)
        .when(kind == "boolean", F.try_variant_get(v, "$", "boolean"))
        .when(kind == "array", F.size(F.try_variant_get(v, "$", "array<variant>")) > 0)
        .otherwise(F.to_json(v) != "{}")
    )


def json_array_text(v, key: str) -> Column:
    """The array at ``key`` as ``array<string>``: nested elements as JSON text, null
    elements as NULL. JSON null, a missing key or a non-array give NULL (explode -> 0 rows)."""
    return F.try_variant_get(_col(v), json_path(key), "array<string>")


def variant_field(v, key: str) -> Column:
    return F.try_variant_get(_col(v), json_path(key), "variant")


__all__ = [
    "as_variant", "canonical_json", "exact_numbers", "is_truthy", "json_array_text",
    "json_kind", "json_path", "json_text", "json_value", "variant_field", "variant_json",
]
