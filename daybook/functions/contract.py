"""JSON message contract as column expressions (JSN-03, STM-02, SRC-04).

A contract is a closed list of fields with a type, a required flag and
optional integer bounds; ``contract_errors`` returns an ``array<string>``
of violations per message, so validation runs distributed and the ok /
dead-letter split is a filter on ``size(errors) = 0``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

INT32_MIN, INT32_MAX = -(2 ** 31), 2 ** 31 - 1

_VARIANT_TYPES = {
    "string": ["STRING"],
    "integer": ["BIGINT", "INT", "SMALLINT", "TINYINT"],
    "boolean": ["BOOLEAN"],
    "number": ["BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "DECIMAL"],
    "array": ["ARRAY"],
    "object": ["OBJECT"],
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str                     # string | integer | boolean | number | array | object
    required: bool = True
    minimum: int | None = None
    exclusive_maximum: int | None = None
    maximum: int | None = None
    pattern: str | None = None    # regex for strings
    items: str | None = None      # element type for arrays


def _type_ok(v: Column, t: str) -> Column:
    sv = F.schema_of_variant(v)
    ok = None
    for prefix in _VARIANT_TYPES[t]:
        c = sv.startswith(prefix)
        ok = c if ok is None else (ok | c)
    if t == "number":
        ok = ok | sv.startswith("DECIMAL")
    return ok


def contract_errors(json_text, fields: list[Field], closed: bool = True) -> Column:
    """``array<string>`` of contract violations of a JSON text column."""
    txt = F.col(json_text) if isinstance(json_text, str) else json_text
    v = F.try_parse_json(txt)
    is_obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    checks: list[Column] = [F.when(~is_obj, F.lit("not a JSON object"))]
    names = [f.name for f in fields]
    for f in fields:
        fv = F.try_variant_get(v, f"$.{f.name}", "variant")
        present = fv.isNotNull() & (F.schema_of_variant(fv) != "VOID")
        if f.required:
            checks.append(F.when(is_obj & ~present, F.lit(f"missing required field {f.name}")))
        tok = _type_ok(fv, f.type)
        checks.append(F.when(is_obj & present & ~tok, F.lit(f"{f.name} is not of type {f.type}")))
        if f.type == "integer":
            iv = F.try_variant_get(v, f"$.{f.name}", "long")
            lo = f.minimum if f.minimum is not None else INT32_MIN
            bad = iv < lo
            if f.exclusive_maximum is not None:
                bad = bad | (iv >= f.exclusive_maximum)
            else:
                bad = bad | (iv > (f.maximum if f.maximum is not None else INT32_MAX))
            checks.append(F.when(is_obj & present & tok & bad, F.lit(f"{f.name} out of range")))
        if f.type == "string" and f.pattern:
            sv = F.try_variant_get(v, f"$.{f.name}", "string")
            checks.append(F.when(is_obj & present & tok & ~sv.rlike(f.pattern),
                                 F.lit(f"{f.name} does not match pattern")))
        if f.type == "array" and f.items:
            arr = F.try_variant_get(v, f"$.{f.name}", "array<variant>")
            el_ok = F.forall(arr, lambda e: _type_ok(e, f.items))
            checks.append(F.when(is_obj & present & tok & ~F.coalesce(el_ok, F.lit(False)),
                                 F.lit(f"{f.name} items are not of type {f.items}")))
    if closed:
        keys = F.json_object_keys(txt)
        extra = F.filter(F.coalesce(keys, F.array().cast("array<string>")),
                         lambda k: ~k.isin(*names))
        checks.append(F.when(is_obj & (F.size(extra) > 0), F.lit("unexpected field")))
    return F.filter(F.array(*checks), lambda e: e.isNotNull())
