"""Deeply nested JSON into related flat tables.

A tree automaton reads each value bottom-up and gives it a state: ``null``, ``scalar``,
``record`` (an object that is one entry), ``map`` (an object whose values are entries)
or ``list``. Texts that hold JSON take the state of what they hold. The productions of
each root route a value's entries to child tables; entries keep the position in which
they are written, their parent, the way they were held (``variant``) and their
``subtype``: the keys whose values are no scalars, with their states. Every subtype shares
the supertype keys (owner, child, pos, sub_pos, parent); ``subtype_table`` has the columns
of its own shape only, ``write_subtypes`` routes all entries to one table a subtype.

Positions follow the order in which objects are written. Spark's variant type sorts the
keys of an object, so the walk is Python, in Arrow batches, once per owner; bodies are
written out only where a table needs them, and only of the children asked for.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

ENTRY_SCHEMA = "owner_table string, owner_id bigint, child string, pos int, sub_pos int, parent string, variant string, subtype string, body string"


@dataclass(frozen=True)
class Production:
    """Entries of ``child`` stand at ``paths`` of the root (an empty path: the root itself).

    ``own`` are keys that mark an object as one entry even when it has no scalar value.
    ``sub`` is the child held by an entry at ``sub_paths``.
    """

    child: str
    paths: tuple[tuple[str, ...], ...]
    own: frozenset[str]
    sub: str | None = None
    sub_paths: tuple[tuple[str, ...], ...] = ()
    sub_own: frozenset[str] = frozenset()
    root_object_is_entry: bool = True


CAMERAS = Production("camera", ((),), frozenset({"type", "mp", "aperture", "ois", "sensor", "video", "modes"}), "camera_mode", (("modes",), ("video", "modes")), frozenset({"res", "fps"}))
PANELS = Production("panel", (("panels",), ()), frozenset({"role", "size_inch", "resolution", "brightness"}), root_object_is_entry=False)
BANDS = Production("band", (("cellular", "bands"),), frozenset({"rat", "numbers"}))
CLUSTERS = Production("cluster", (("clusters",),), frozenset({"core", "count", "clocks"}), "clock", (("clocks",),), frozenset({"mode", "mhz"}))

TYPED = {
    "camera": "type string, mp double, aperture double, ois boolean, sensor struct<code string, size_in string>, video struct<codec string>",
    "camera_mode": "res string, fps array<int>",
    "panel": "role string, size_inch double, resolution string, brightness struct<typ int, peak int>",
    "band": "rat string, numbers array<int>",
    "cluster": "core string, count int",
    "clock": "mode string, mhz double",
}


def opened(value):
    """A text that holds JSON becomes what it holds, as often as it was encoded; a broken one is a scalar."""
    while isinstance(value, str):
        s = value.strip().lstrip("﻿")
        if s[:1] not in ("{", "[", '"'):
            return None if s in ("", "null") else value
        try:
            value = json.loads(s)
        except ValueError:
            return value
    return value


def state(value, own: frozenset[str]) -> str:
    """The automaton's state of an opened value."""
    if value is None:
        return "null"
    if isinstance(value, list):
        return "list"
    if not isinstance(value, dict):
        return "scalar"
    if not value:
        return "empty"
    if own & value.keys():
        return "record"
    return "map" if all(v is None or isinstance(v, (dict, list)) or isinstance(opened(v), (dict, list)) for v in value.values()) else "record"


def entries(value, own: frozenset[str], path: str = "") -> Iterator[tuple[object, str]]:
    """Entries in the order written with the shape they came in; null and empty ones are yielded too."""
    value = opened(value)
    kind = state(value, own)
    if kind == "list":
        for v in value:
            v = opened(v)
            if isinstance(v, list):
                yield from entries(v, own, path + "list.")
            else:
                yield v, path + "list"
    elif kind == "map":
        for v in value.values():
            v = opened(v)
            if isinstance(v, list):
                yield from entries(v, own, path + "map.")
            else:
                yield v, path + "map"
    elif kind == "record":
        yield value, path + "record"


def reach(value, path: tuple[str, ...]):
    for key in path:
        value = opened(value)
        if not isinstance(value, dict):
            return None
        value = value.get(key)
    return opened(value)


def children(text: str | None, rule: Production) -> Iterator[tuple[str, int, int, str, str, dict]]:
    """All non-empty entries of a root and of the entries below them."""
    root = opened(text)
    pos = 0
    for path in rule.paths:
        at = reach(root, path)
        if not path and not rule.root_object_is_entry and not isinstance(at, list):
            continue
        for entry, variant in entries(at, rule.own):
            if isinstance(entry, dict) and entry:
                yield rule.child, pos, -1, "", variant, entry
                if rule.sub:
                    k = 0
                    for sub_path in rule.sub_paths:
                        for sub, sub_variant in entries(reach(entry, sub_path), rule.sub_own):
                            if isinstance(sub, dict) and sub:
                                yield rule.sub, pos, k, f"{rule.child}:{pos}", ".".join((*sub_path[:-1], sub_variant)), sub
                            k += 1
            pos += 1


def subtype(entry: dict) -> str:
    """The keys of an entry that hold more than a scalar, with their states; "flat" without any."""
    parts = [f"{k}:{kind}" for k, kind in sorted((k, state(opened(v), frozenset())) for k, v in entry.items()) if kind in ("list", "map", "record")]
    return "+".join(parts) or "flat"


def flatten(rows: DataFrame, owner_table: str, columns: dict[str, Production], id_col: str = "id", only: str | None = None, bodies: bool = True) -> DataFrame:
    """Child rows of the JSON columns of ``rows`` (one row per owner).

    Null, blank and broken JSON and JSON of another kind give no row. ``pos`` counts the
    entries of a kind over the whole owner, ``sub_pos`` those of a parent, else -1. With
    ``only`` one child is read, and other columns are not touched; without ``bodies`` body
    is null.
    """
    columns = {n: rule for n, rule in columns.items() if only in (None, rule.child, rule.sub)}
    names = list(columns)
    if not names:
        return rows.sparkSession.createDataFrame([], ENTRY_SCHEMA)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for owner, *texts in pdf[["owner_id", *names]].itertuples(index=False, name=None):
                for name, text in zip(names, texts):
                    if text is None:
                        continue
                    for child, pos, sub, parent, variant, body in children(text, columns[name]):
                        if only is None or child == only:
                            out.append((owner_table, owner, child, pos, sub, parent, f"{name}.{variant}", subtype(body), json.dumps(body, ensure_ascii=False) if bodies else None))
            yield pd.DataFrame(out, columns=["owner_table", "owner_id", "child", "pos", "sub_pos", "parent", "variant", "subtype", "body"])

    return rows.select(F.col(id_col).cast("bigint").alias("owner_id"), *names).mapInPandas(read, ENTRY_SCHEMA)


def typed_table(flat: DataFrame, child: str) -> DataFrame:
    """The table of one child over all its subtypes: supertype keys, parent link and typed columns.

    A value of another type than the column's is null; the body keeps it.
    """
    parsed = flat.where(F.col("child") == child).withColumn("_b", F.from_json("body", TYPED[child]))
    return parsed.select("owner_table", "owner_id", "pos", "sub_pos", "parent", "variant", "subtype", "_b.*", "body")


def subtype_table(flat: DataFrame, child: str, shape: str) -> DataFrame:
    """One subtype of a child: the supertype keys, its scalar columns and those of its own nested keys."""
    held = {part.split(":")[0] for part in shape.split("+")} if shape != "flat" else set()
    columns = [f.name for f in StructType.fromDDL(TYPED[child]).fields if not isinstance(f.dataType, (StructType, ArrayType)) or f.name in held]
    return typed_table(flat.where(F.col("subtype") == shape), child).select("owner_table", "owner_id", "pos", "sub_pos", "parent", *columns)


def write_subtypes(flat: DataFrame, path: str) -> None:
    """All entries routed to one folder per child and subtype."""
    flat.hint("rebalance", "child", "subtype").write.mode("overwrite").partitionBy("child", "subtype").parquet(path)


def variants(flat: DataFrame) -> DataFrame:
    """How many entries of each child came in each way and shape."""
    return flat.groupBy("owner_table", "child", "variant", "subtype").agg(F.count(F.lit(1)).alias("n"))
