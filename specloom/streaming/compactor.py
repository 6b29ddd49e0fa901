"""Consolidating very many small files into few well-sized ones.

A checkpointed file stream discovers every input file once and hands over what is there
in batches of so many bytes. Records lie in buckets of their ids. A batch reads only the
buckets it touches, settles which file holds each record first on ids alone, and writes
these buckets anew under its batch number, in files of the size AQE's rebalancing gives;
a batch that is tried again replaces what its first try left. A manifest names the version
of each bucket that counts; other buckets are not read or written.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.session import cut, shared_path

#: Bytes of files a batch takes, and buckets of record ids.
BATCH_BYTES = 16 * 2**30
BUCKETS = 8
RECORD_SCHEMA = "record_uid bigint, file_id bigint, record string"


def _uid(value: object) -> int | None:
    if isinstance(value, bool):
        return None
    if isinstance(value, int):
        return value if -(2**63) <= value < 2**63 else None
    if isinstance(value, str) and value.strip().lstrip("-").isdecimal() and len(value.strip()) < 19:
        return int(value)
    return None


def _walk(value: object, key: str) -> Iterator[dict]:
    stack = [value]
    while stack:
        v = stack.pop()
        if isinstance(v, dict):
            if _uid(v.get(key)) is not None:
                yield v
            else:
                stack.extend(v.values())
        elif isinstance(v, list):
            stack.extend(v)


_DECODER = json.JSONDecoder()


def whole_records(body: str | None, key: str = "record_uid") -> list[dict]:
    """Every JSON object with ``key`` that stands whole in a body.

    Bodies hold one object, a list, lines or objects in a wrapper, with or without a byte
    order mark; of a body that breaks off, the objects before the break count. Null and
    blank bodies hold none.
    """
    if not body or "{" not in body:
        return []
    try:
        return list(_walk(json.loads(body.lstrip("﻿ \t\r\n")), key))
    except (ValueError, RecursionError):
        pass
    out, at = [], body.find("{")
    while at >= 0:
        try:
            value, end = _DECODER.raw_decode(body, at)
            out += _walk(value, key)
        except (ValueError, RecursionError):
            end = at + 1
        at = body.find("{", end)
    return out


def records(files: DataFrame, id_col: str = "file_id", body_col: str = "body", key: str = "record_uid") -> DataFrame:
    """All whole records of all files (record_uid, file_id, record)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(_uid(r[key]), fid, json.dumps(r, ensure_ascii=False, separators=(",", ":"))) for fid, body in zip(pdf["file_id"], pdf["body"]) for r in whole_records(body, key)]
            yield pd.DataFrame(out, columns=["record_uid", "file_id", "record"])

    return files.where(f"{id_col} is not null").select(F.col(id_col).cast("bigint").alias("file_id"), F.col(body_col).alias("body")).mapInPandas(read, RECORD_SCHEMA)


class Store:
    """Consolidated records below a folder: ``records`` by turn and bucket, and the ``manifest``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets

    def manifest(self, before: int | None = None) -> dict[int, int]:
        """The turn whose version of each bucket counts, as of turn ``before`` if given; one row a bucket and turn is read."""
        try:
            rows = self.spark.read.schema("bucket int, turn int").parquet(f"{self.path}/manifest").collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return {}
            raise
        out: dict[int, int] = {}
        for r in rows:
            if before is None or r["turn"] < before:
                out[r["bucket"]] = max(out.get(r["bucket"], -1), r["turn"])
        return out

    def table(self, which: dict[int, int] | None = None) -> DataFrame:
        """The records of some versions of buckets, by default of all that count."""
        which = self.manifest() if which is None else which
        paths = [f"{self.path}/records/turn={t}/bucket={b}" for b, t in sorted(which.items())]
        return self.spark.read.schema(RECORD_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], RECORD_SCHEMA)

    def add(self, found: DataFrame, turn: int) -> None:
        """Take in records; the lowest file that holds a record counts, among equals the first read.

        What decides travels without the records' texts. The losers are written, so where they
        are few the texts are not shuffled to be filtered; they move once, to their buckets.
        """
        bucket = F.pmod(F.xxhash64("record_uid"), F.lit(self.buckets)).cast("int")
        # Each row needs a number that a second reading of it keeps, hence a written table.
        path = shared_path(self.spark, "compact-staged")
        found.select("record_uid", "file_id", "record", F.monotonically_increasing_id().alias("row"), bucket.alias("bucket")).write.parquet(path)
        staged = self.spark.read.schema(RECORD_SCHEMA + ", row bigint, bucket int").parquet(path)
        touched = [r["bucket"] for r in staged.select("bucket").distinct().collect()]  # at most ``buckets`` rows
        old = self.table({b: t for b, t in self.manifest(turn).items() if b in touched}).select("record_uid", "file_id", "record", F.lit(-1).cast("bigint").alias("row"), bucket.alias("bucket"))
        every = staged.unionByName(old)
        ids = every.select("record_uid", "file_id", "row")
        best = ids.groupBy("record_uid").agg(F.min(F.struct("file_id", "row")).alias("best"))
        losers = cut(ids.join(best, "record_uid").where(F.struct("file_id", "row") != F.col("best")).select("record_uid", "row"), "compact-losers")
        kept = every.join(losers, ["record_uid", "row"], "left_anti")
        kept.select("record_uid", "file_id", "record", "bucket").hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/records/turn={turn}")
        if touched:
            self.spark.createDataFrame([(b, turn) for b in touched], "bucket int, turn int").coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        self.spark.createDataFrame([], RECORD_SCHEMA).write.mode("overwrite").parquet(path)  # gives its space back

    def vacuum(self) -> int:
        """Empty the versions of buckets that no longer count; readers of older versions must be done. Gives their number."""
        rows = self.spark.read.schema("bucket int, turn int").parquet(f"{self.path}/manifest").distinct().collect()
        now = self.manifest()
        stale = [(r["bucket"], r["turn"]) for r in rows if now[r["bucket"]] != r["turn"]]
        for b, t in stale:
            self.spark.createDataFrame([], RECORD_SCHEMA).write.mode("overwrite").parquet(f"{self.path}/records/turn={t}/bucket={b}")
        return len(stale)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path holds files rather than being one; an empty table counts as a folder unless its only file is the path."""
    first = spark.read.parquet(path).select("_metadata.file_path").first()
    found = unquote(first[0]) if first else next(iter(spark.read.parquet(path).inputFiles()), "")
    return not unquote(found).endswith("/" + path.rstrip("/").rpartition("/")[2])


def compact(spark: SparkSession, source: str, target: str | None = None, checkpoint: str | None = None, batch_bytes: int = BATCH_BYTES, buckets: int = BUCKETS) -> DataFrame:
    """Take in all files below ``source`` that no earlier run has and give the consolidated records.

    With the ``target`` (and ``checkpoint``) of an earlier run only new files are read, and
    only buckets that their records fall into are written. A batch is ``batch_bytes`` of
    files, however many these are.
    """
    target = target or shared_path(spark, "compact")
    checkpoint = checkpoint or f"{target}/_checkpoint"
    store = Store(spark, target, buckets)
    reader = spark.readStream.schema(spark.read.parquet(source).schema).option("maxBytesPerTrigger", batch_bytes)
    if not is_folder(spark, source):  # a file stream reads folders; one file is its folder narrowed to its name
        folder, _, name = source.rpartition("/")
        reader, source = reader.option("pathGlobFilter", name), folder
    stream = reader.parquet(source).select("file_id", "body")
    query = stream.writeStream.foreachBatch(lambda batch, number: store.add(records(batch), number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return store.table()
