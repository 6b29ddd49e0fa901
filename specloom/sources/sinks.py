"""Sinks: insert if absent, static JSON trees, line logs and the flip of a flag in raw text."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from specloom.session import cut


def absent(new: DataFrame, held: DataFrame | None, key: str = "slug", *order: str) -> DataFrame:
    """Rows whose key is not held; of equal keys the first in order (of all columns without one). Null keys are none."""
    rest = [c for c in new.columns if c != key]
    fresh = new.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*(order or rest))).alias("_r")).select(key, "_r.*").select(*new.columns)
    return fresh if held is None else fresh.join(held.select(key), key, "left_anti").select(*new.columns)


def insert_if_absent(new: DataFrame, path: str, key: str = "slug", *order: str) -> tuple[DataFrame, dict[str, int]]:
    """Appends the rows whose key the table does not hold; gives them, and the counts of given and inserted rows.

    What is new is written beside the table first, so reading and appending do not meet.
    """
    spark = new.sparkSession
    try:
        held = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        held = None
    fresh = cut(absent(new, held, key, *order), "insert")
    fresh.write.mode("append").parquet(path)
    return fresh, {"given": new.count(), "inserted": fresh.count()}


def write_files(rows: DataFrame, root: str) -> int:
    """Writes each row's ``text`` to the file ``path`` below root, by the executors; gives their number.

    A file appears whole or not at all: it is written beside its place and then moved there.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        for pdf in batches:
            for path, text in zip(pdf["path"], pdf["text"]):
                name = f"{base.rstrip('/')}/{path}"
                store.create_dir(name.rpartition("/")[0], recursive=True)
                part = f"{name}.{uuid.uuid4().hex[:8]}.part"
                with store.open_output_stream(part) as f:
                    f.write((text or "").encode("utf-8", "surrogatepass"))
                store.move(part, name)
            yield pd.DataFrame({"n": [len(pdf)]})

    return rows.select("path", "text").mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


@pandas_udf(StringType())
def pretty(raw: pd.Series) -> pd.Series:
    """JSON texts as documents are kept: two blanks a level, other scripts as they are, a line end; null for what is no JSON."""

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(json.loads(text), indent=2, ensure_ascii=False) + "\n"
        except ValueError:
            return None

    return raw.map(one)


def dump_files(details: DataFrame, resource: str, scores: DataFrame | None = None) -> DataFrame:
    """(path, text) of a collection's static files: one a detail and, where scored, one a score.

    ``details`` has slug; ``scores`` has slug and its columns. Rows without a slug have no file.
    """
    text = lambda df: pretty(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    files = details.where("slug <> ''").select(F.format_string(f"v1/{resource}/%s/index.json", "slug").alias("path"), text(details).alias("text"))
    if scores is not None:
        files = files.unionByName(scores.where("slug <> ''").select(F.format_string(f"v1/{resource}/%s/score/index.json", "slug").alias("path"), text(scores).alias("text")))
    return files


def write_list(refs: DataFrame, root: str, resource: str) -> int:
    """The list file of a collection: count and results in order of name and slug; gives the count.

    One file by contract, so one task writes it, a row at a time.
    """
    n = refs.count()
    if not n:  # an empty table has no task that would write
        return n * write_files(refs.sparkSession.createDataFrame([(f"v1/{resource}/index.json", '{\n  "count": 0,\n  "results": []\n}\n')], "path string, text string"), root)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        name = f"{base.rstrip('/')}/v1/{resource}/index.json"
        store.create_dir(name.rpartition("/")[0], recursive=True)
        with store.open_output_stream(name) as f:
            f.write(f'{{\n  "count": {n},\n  "results": ['.encode())
            first = True
            for pdf in batches:
                for row in pdf.to_dict("records"):
                    f.write(("" if first else ",").encode() + b"\n    " + json.dumps(row, ensure_ascii=False).encode())
                    first = False
            f.write(b"\n  ]\n}\n")
        yield pd.DataFrame({"n": [1]})

    refs.select("slug", "name", "url").orderBy("name", "slug").coalesce(1).mapInPandas(write, "n long").collect()
    return n


def manifest(collections: dict[str, DataFrame], scored: str = "overall") -> DataFrame:
    """(collection, records, scored) in one row each."""
    out = None
    for name, df in collections.items():
        n = F.count(F.col(scored)) if scored in df.columns else F.lit(0).cast("bigint")
        one = df.agg(F.count(F.lit(1)).alias("records"), n.alias("scored")).select(F.lit(name).alias("collection"), "records", "scored")
        out = one if out is None else out.unionByName(one)
    return out


def dump(root: str, refs: dict[str, DataFrame], details: dict[str, DataFrame], scores: dict[str, DataFrame] | None = None) -> dict:
    """All static files of some collections and their manifest, which is also given back."""
    scores, entries = scores or {}, {}
    for name in refs:
        count = write_list(refs[name], root, name)
        write_files(dump_files(details[name], name, scores.get(name)), root)
        entries[name] = {"count": count, "url": f"/v1/{name}/index.json"}
        if name in scores:
            entries[name]["scored"] = scores[name].where("overall is not null").count()
    out = {"version": "v1", "collections": entries}
    spark = next(iter(refs.values())).sparkSession if refs else None
    if spark is not None:
        write_files(spark.createDataFrame([("v1/index.json", json.dumps(out, indent=2) + "\n")], "path string, text string"), root)
    return out


def flip_file(rows: DataFrame, root: str) -> int:
    """Sets the flag of the documents (path, raw) that can be flipped and writes them back; gives their number."""
    flipped = rows.select("path", flip_verified(F.col("raw")).alias("text")).where("text is not null")
    return write_files(flipped, root)


def flip_verified(raw: Column) -> Column:
    """Raw JSON text with its one top-level false flag made true; null where it has none or several."""
    flag = r'(?m)^  "verified": false(?=,?\s*$)'
    return F.when(F.regexp_count(raw, F.lit(flag)) == 1, F.regexp_replace(raw, flag, '  "verified": true'))
