"""JSON metadata column builders (M1-M6).

Metadata is stored as a JSON object string. Paths are read through VARIANT
(``try_parse_json`` + ``variant_get``), which keeps JSON types apart: the
containment test must not take the string ``"1"`` for the number ``1``.
"""

from __future__ import annotations

import json
import re
from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry import config

_NUMERIC = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")
_INTEGRAL = ("TINYINT", "SMALLINT", "INT", "BIGINT")
_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _key_path(key: str) -> str:
    if _IDENT.match(key):
        return f"$.{key}"
    return f"$['{key}']"


def _child(v: Column, key: str) -> Column:
    """The member ``key`` of an object; NULL if absent. A key that a path cannot
    spell is read from the object as a map."""
    if _IDENT.match(key) or not re.search(r"['\"\\\]]", key):
        return F.variant_get(v, _key_path(key), "variant")
    return F.try_element_at(F.try_variant_get(v, "$", "map<string,variant>"), F.lit(key))


def _type(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_number(v: Column) -> Column:
    t = _type(v)
    return t.isin(*_NUMERIC) | t.startswith("DECIMAL")


def _contains(v: Column, f: Any) -> Column:
    """``v @> f`` for a VARIANT node ``v`` and a Python JSON value ``f``."""
    if isinstance(f, dict):
        cond = _type(v).startswith("OBJECT")
        for k, sub in f.items():
            child = _child(v, k)
            cond = cond & child.isNotNull() & _contains(child, sub)
        return cond
    if isinstance(f, list):
        cond = _type(v).startswith("ARRAY")
        arr = F.variant_get(v, "$", "array<variant>")
        for e in f:
            cond = cond & F.exists(arr, _element_test(e))
        return cond
    if f is None:
        return F.is_variant_null(v)
    if isinstance(f, bool):
        return (_type(v) == "BOOLEAN") & (F.variant_get(v, "$", "boolean") == F.lit(f))
    if isinstance(f, int) and abs(f) < 10 ** 38:
        # whole numbers are compared as such: a double cannot tell them apart from 2**53 on
        whole = _type(v).isin(*_INTEGRAL) | _type(v).rlike(r"^DECIMAL\(\d+,0\)$")
        exact = F.variant_get(v, "$", "decimal(38,0)") == F.lit(Decimal(f)).cast("decimal(38,0)")
        return _is_number(v) & F.when(whole, exact).otherwise(
            F.variant_get(v, "$", "double") == F.lit(float(f)))
    if isinstance(f, (int, float)):
        return _is_number(v) & (F.variant_get(v, "$", "double") == F.lit(float(f)))
    if isinstance(f, str):
        return (_type(v) == "STRING") & (F.variant_get(v, "$", "string") == F.lit(f))
    raise TypeError(f"not a JSON value: {f!r}")


def _element_test(e: Any):
    return lambda y: F.coalesce(_contains(y, e), F.lit(False))


def json_contains(meta: Column, filt: dict | str | None) -> Column:
    """M4: ``meta @> filt``. The filter is a driver literal compiled into a
    Column tree (no UDF); ``{}`` or None matches every object."""
    return json_contains_variant(F.try_parse_json(meta), filt)


def hot_keys(v: Column, keys=config.HOT_META_KEYS) -> Column:
    """The string values of the indexed metadata keys as a struct of real
    columns (NULL where the key is absent or not a string): Parquet can
    push an equality on them, which it cannot do on a JSON path."""
    def one(k):
        node = F.variant_get(v, _key_path(k), "variant")
        return F.when(F.schema_of_variant(node) == "STRING",
                      F.variant_get(node, "$", "string")).alias(k)
    return F.struct(*[one(k) for k in keys])


def metadata_filter(df, filt: dict | str | None) -> Column:
    """M4 over a chunk table: the stored VARIANT ``meta_v`` where there is
    one, the JSON text ``metadata`` parsed otherwise. A string value on an
    indexed key also becomes an equality on ``meta_hot`` (pushed to the
    scan, a necessary condition of containment)."""
    if isinstance(filt, str):
        filt = json.loads(filt)
    if "meta_v" in df.columns:
        cond = json_contains_variant(
            F.coalesce(F.col("meta_v"), F.try_parse_json(F.col("metadata"))), filt)
    else:
        cond = json_contains(F.col("metadata"), filt)
    if "meta_hot" in df.columns and isinstance(filt, dict):
        for k, val in filt.items():
            if k in config.HOT_META_KEYS and isinstance(val, str):
                hot = F.col("meta_hot").getField(k)
                # NULL also in rows written without the column
                cond = ((hot == F.lit(val)) | hot.isNull()) & cond
    return cond


def json_contains_variant(v: Column, filt: dict | str | None) -> Column:
    """M4 on metadata already stored as VARIANT (no parse per row)."""
    if isinstance(filt, str):
        filt = json.loads(filt)
    if filt is None:
        filt = {}
    return F.coalesce(_contains(v, filt), F.lit(False))


def json_field(meta: Column, key: str) -> Column:
    """M3: ``meta->>'key'`` as text."""
    return F.get_json_object(meta, _key_path(key))


def json_has_key(meta: Column, key: str) -> Column:
    """M5: ``meta ? 'key'``; true also when the value is JSON null."""
    return F.coalesce(F.array_contains(F.json_object_keys(meta), key), F.lit(False))


def merge_metadata(base: Column, extra: dict[str, Column], optional: tuple[str, ...] = ()) -> Column:
    """M1 + M2: all keys of the JSON object ``base``, then ``extra``'s keys,
    the later ones winning; serialised back to a JSON string (non-ASCII kept).
    Keys named in ``optional`` are left out where their value is NULL.

    ``map_concat`` refuses duplicate keys, so clashing keys are filtered out
    of the base first."""
    names = list(extra)
    m = F.coalesce(F.from_json(base, "map<string,variant>"),
                   F.create_map().cast("map<string,variant>"))
    kept = F.map_filter(m, lambda k, v: ~k.isin(*names))
    add = F.create_map(*[x for n in names for x in (F.lit(n), extra[n].cast("variant"))])
    if optional:
        add = F.map_filter(add, lambda k, v: v.isNotNull() | ~k.isin(*optional))
    return F.to_json(F.map_concat(kept, add))


def jsonb_text(meta: Column) -> Column:
    """M6: the object's text with keys in JSONB order (shorter keys first,
    then by bytes), ``''`` for NULL. Used only to tokenise metadata, so the
    separators do not matter; nested values keep their own key order."""
    m = F.from_json(meta, "map<string,variant>")
    ents = F.array_sort(F.map_entries(m), lambda a, b: F.when(
        F.octet_length(a.key) != F.octet_length(b.key),
        F.octet_length(a.key) - F.octet_length(b.key)).otherwise(
        F.when(a.key.cast("binary") < b.key.cast("binary"), -1)
         .when(a.key.cast("binary") > b.key.cast("binary"), 1).otherwise(0)))
    body = F.array_join(F.transform(ents, lambda e: F.concat(
        F.regexp_replace(F.to_json(F.array(e.key)), r"^\[|\]$", ""), F.lit(": "),
        F.to_json(e.value))), ", ")
    return F.coalesce(F.concat(F.lit("{"), body, F.lit("}")), F.lit(""))
