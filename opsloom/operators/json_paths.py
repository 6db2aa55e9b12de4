"""Nested schema of JSON records: every path with its types, over all records."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["array", "boolean", "integer", "null", "number", "object", "string"]
PLAIN_KEY = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
PATHS_HELD = 50_000
COUNTS = ", ".join(f"n_{k} long" for k in KINDS)


def kind_of(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    for kind, types in (("integer", int), ("number", float), ("string", str), ("array", list)):
        if isinstance(value, types):
            return kind
    return "object"


def child_path(parent: str, key: str) -> str:
    """Keys of other than word characters are quoted, so no two fields share a path."""
    if PLAIN_KEY.fullmatch(key):
        return f"{parent}.{key}" if parent else key
    return f"{parent}[{json.dumps(key)}]"


def paths_of(record: dict) -> Iterator[tuple[str, str, str]]:
    """(path, path of what holds it, kind) of every value below an object; the root's path is ''."""
    todo: list[tuple[str, str, object]] = [("", "", record)]
    while todo:
        path, parent, value = todo.pop()
        yield path, parent, kind_of(value)
        if isinstance(value, dict):
            todo += [(child_path(path, key), path, v) for key, v in value.items()]
        elif isinstance(value, list):
            todo += [(f"{path}[]", path, v) for v in value]


def _no_constant(name: str) -> None:
    raise ValueError(name)


def _parsed(line: str | None) -> dict | None:
    try:
        record = json.loads(line or "", parse_constant=_no_constant)
    except (ValueError, RecursionError):
        return None
    return record if isinstance(record, dict) else None


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per path and kind, added up before they are shuffled."""
    held: dict[tuple[str, str], list[int]] = {}

    def out() -> pa.RecordBatch:
        names = ["field", "parent", *[f"n_{k}" for k in KINDS]]
        keys = [[path for path, _ in held], [parent for _, parent in held]]
        counts = [[n[i] for n in held.values()] for i in range(len(KINDS))]
        columns = [pa.array(k, pa.string()) for k in keys] + [pa.array(c, pa.int64()) for c in counts]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        for line in batch.column(0):
            record = _parsed(line.as_py())
            if record is None:
                continue
            for path, parent, kind in paths_of(record):
                held.setdefault((path, parent), [0] * len(KINDS))[KINDS.index(kind)] += 1
            if len(held) >= PATHS_HELD:
                yield out()
                held.clear()
    yield out()


def merged_types() -> Column:
    """The kinds met, in order and joined by ``|``: whole numbers and others together are numbers,
    null adds nothing to another kind."""
    met = {k: F.col(f"n_{k}") > 0 for k in KINDS}
    met["integer"] = met["integer"] & ~met["number"]
    others = [met[k] for k in KINDS if k != "null"]
    any_other = others[0]
    for other in others[1:]:
        any_other = any_other | other
    met["null"] = met["null"] & ~any_other
    return F.array_join(F.array_compact(F.array(*[F.when(met[k], k) for k in KINDS])), "|")


def nested_schema(lines: DataFrame, column: str) -> DataFrame:
    """One row per path of JSON objects given as text: field, types, present, nulls, missing, parents.

    ``messages[].role`` is the field of the objects in a list. ``present`` counts all values at
    the path, ``parents`` the objects that could hold it (for a list's elements: the lists), and
    ``missing`` those of them that lack it (none for elements). Lines that are no JSON object (null,
    broken, other values, NaN) count nowhere; of a key that an object repeats the last counts.
    """
    counted = lines.select(column).mapInArrow(_counted, f"field string, parent string, {COUNTS}")
    kinds = [f"n_{k}" for k in KINDS]
    paths = counted.groupBy("field", "parent").agg(*[F.sum(k).alias(k) for k in kinds])
    holders = paths.select(
        F.col("field").alias("parent"), F.col("n_object").alias("_objects"), F.col("n_array").alias("_lists")
    )
    present = sum((F.col(k) for k in kinds[1:]), F.col(kinds[0]))
    element = F.col("field") == F.concat("parent", F.lit("[]"))
    return paths.where("field != ''").join(holders, "parent").select(
        "field", merged_types().alias("types"), present.alias("present"), F.col("n_null").alias("nulls"),
        F.when(element, 0).otherwise(F.col("_objects") - present).cast("bigint").alias("missing"),
        F.when(element, F.col("_lists")).otherwise(F.col("_objects")).alias("parents"),
    )
