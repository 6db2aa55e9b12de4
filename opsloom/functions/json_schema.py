"""JSON Schema documents as columns: a schema is compiled to one native expression.

Known are type (one or a list), enum, const, required, properties, additionalProperties (true
or false), items, minItems, maxItems, minLength, maxLength, pattern, minimum, maximum,
exclusiveMinimum, exclusiveMaximum, allOf, anyOf, oneOf, not, and local references (``#/...``).
Any other rule is an error, so no schema is applied in part.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsloom.functions import chats
from opsloom.functions.common import col, let

NOTES = {"$schema", "$id", "$comment", "$defs", "definitions", "title", "description", "default", "examples"}
BOUNDS = {
    "minimum": lambda x, n: x >= n, "maximum": lambda x, n: x <= n,
    "exclusiveMinimum": lambda x, n: x > n, "exclusiveMaximum": lambda x, n: x < n,
}
SIZES = {
    "minLength": ("string", F.length, "minimum"), "maxLength": ("string", F.length, "maximum"),
    "minItems": ("array<variant>", F.array_size, "minimum"), "maxItems": ("array<variant>", F.array_size, "maximum"),
}


def _as(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def _is_number(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def _has_type(value: Column, name: str) -> Column:
    kind = F.schema_of_variant(value)
    if name == "integer":
        # a number without a fraction, 1.0 as well
        return (kind == "BIGINT") | (
            kind.startswith("DECIMAL") & value.cast("string").rlike(r"^-?\d+(\.0*)?$")
        ) | ((kind == "DOUBLE") & (_as(value, "double") % 1 == 0))
    return {
        "object": lambda: kind.startswith("OBJECT"), "array": lambda: kind.startswith("ARRAY"),
        "string": lambda: kind == "STRING", "boolean": lambda: kind == "BOOLEAN",
        "null": lambda: kind == "VOID", "number": lambda: _is_number(value),
    }[name]()


def _equals(value: Column, wanted: Any) -> Column:
    if wanted is None:
        return _has_type(value, "null")
    if isinstance(wanted, bool):
        return _has_type(value, "boolean") & (_as(value, "boolean") == F.lit(wanted))
    if isinstance(wanted, str):
        return _has_type(value, "string") & (_as(value, "string") == F.lit(wanted))
    if isinstance(wanted, int):
        return _is_number(value) & (_as(value, "decimal(38,9)") == F.lit(wanted))
    if isinstance(wanted, float):
        return _is_number(value) & (_as(value, "double") == F.lit(wanted))
    raise ValueError(f"enum and const take plain values, not {wanted!r}")


def _field(value: Column, key: str) -> Column:
    if "'" in key or "\\" in key:
        raise ValueError(f"property name {key!r}")
    return F.try_variant_get(value, f"$['{key}']", "variant")


def _resolved(root: Mapping[str, Any], reference: str) -> Any:
    if not reference.startswith("#"):
        raise ValueError(f"reference {reference!r} is not local")
    found: Any = root
    for step in filter(None, reference[1:].split("/")):
        found = found[step.replace("~1", "/").replace("~0", "~")]
    return found


def _conforms(value: Column, schema: Any, root: Mapping[str, Any], open_references: tuple[str, ...]) -> Column:
    """Whether a variant (never SQL null) keeps all rules of the schema; never null."""
    if isinstance(schema, bool):
        return F.lit(schema)

    def sub(inner: Column, rules: Any) -> Column:
        return _conforms(inner, rules, root, open_references)

    def optional(rules: Any):
        return lambda v: v.isNull() | sub(v, rules)

    def element(rules: Any):
        return lambda v: sub(v, rules)

    def unless(of_other_type: Column, rule: Column) -> Column:
        return of_other_type | F.coalesce(rule, F.lit(False))

    checks = []
    for name, rule in schema.items():
        if name in NOTES or name in ("required", "additionalProperties"):
            continue
        if name == "$ref":
            if rule in open_references:
                raise ValueError(f"reference {rule!r} leads back to itself")
            checks.append(_conforms(value, _resolved(root, rule), root, (*open_references, rule)))
        elif name == "type":
            names = [rule] if isinstance(rule, str) else rule
            checks.append(reduce(or_, [_has_type(value, n) for n in names]))
        elif name in ("enum", "const"):
            allowed = rule if name == "enum" else [rule]
            checks.append(reduce(or_, [_equals(value, w) for w in allowed], F.lit(False)))
        elif name == "properties":
            fits = [let(_field(value, key), optional(rules)) for key, rules in rule.items()]
            checks.append(unless(~_has_type(value, "object"), reduce(and_, fits, F.lit(True))))
        elif name == "items":
            every = F.forall(_as(value, "array<variant>"), element(rule))
            checks.append(unless(~_has_type(value, "array"), every))
        elif name in SIZES:
            kind, size, bound = SIZES[name]
            of_kind = _has_type(value, "string" if kind == "string" else "array")
            checks.append(unless(~of_kind, BOUNDS[bound](size(_as(value, kind)), rule)))
        elif name == "pattern":
            checks.append(unless(~_has_type(value, "string"), _as(value, "string").rlike(rule)))
        elif name in BOUNDS:
            checks.append(unless(~_is_number(value), BOUNDS[name](_as(value, "double"), float(rule))))
        elif name == "allOf":
            checks += [sub(value, s) for s in rule]
        elif name == "anyOf":
            checks.append(reduce(or_, [sub(value, s) for s in rule]))
        elif name == "oneOf":
            checks.append(reduce(lambda a, b: a + b, [sub(value, s).cast("int") for s in rule]) == 1)
        elif name == "not":
            checks.append(~sub(value, rule))
        else:
            raise ValueError(f"schema rule {name!r} is not known")
    for key in schema.get("required", []):
        checks.append(unless(~_has_type(value, "object"), _field(value, key).isNotNull()))
    if schema.get("additionalProperties", True) is not True:
        if schema["additionalProperties"] is not False:
            raise ValueError("additionalProperties takes true or false")
        known = F.array(*[F.lit(k) for k in schema.get("properties", {})]).cast("array<string>")
        keys = F.json_object_keys(F.to_json(value))
        checks.append(unless(~_has_type(value, "object"), F.array_size(F.array_except(keys, known)) == 0))
    return reduce(and_, [F.coalesce(c, F.lit(False)) for c in checks], F.lit(True))


def conforms(text: Column | str, schema: Mapping[str, Any] | str) -> Column:
    """True if the text is one valid JSON value that keeps the schema (a mapping or JSON text).

    Null and broken texts, and objects that repeat a key, do not conform.
    """
    document = json.loads(schema) if isinstance(schema, str) else schema
    parsed = F.try_parse_json(F.when(chats.is_json(col(text)), col(text)))
    return let(parsed, lambda v: v.isNotNull() & F.coalesce(_conforms(v, document, document, ()), F.lit(False)))
