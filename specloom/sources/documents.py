"""Trees of JSON documents, JSON lines and zipped snapshots."""

from __future__ import annotations

import io
import os
import subprocess
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Categories that verification reads.
VERIFIED_CATEGORIES = ("brand", "soc", "smartphone", "tablet", "watch", "pda", "gpu", "cpu")


def data_root(environ: dict[str, str] | None = None, beside: str = "catalog", start: str = ".") -> str:
    """Where documents lie: SPECLOOM_DATA, else ``data`` of a checkout beside this one, else ``data`` within it."""
    env = os.environ if environ is None else environ
    if env.get("SPECLOOM_DATA"):
        return env["SPECLOOM_DATA"]
    here = os.path.abspath(start)
    sibling = os.path.join(os.path.dirname(here), beside, "data")
    return sibling if os.path.isdir(sibling) else os.path.join(here, "data")


def _files(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def _with_path(df: DataFrame, root: str) -> DataFrame:
    """``value`` and the file's place below root as ``path``."""
    base = root.rstrip("/").removeprefix("file://").removeprefix("file:")
    return df.select(F.substring_index(F.url_decode(F.regexp_replace("_metadata.file_path", "[+]", "%2B")), base + "/", -1).alias("path"), "value")


def json_tree(spark: SparkSession, root: str, hidden: bool = True) -> DataFrame:
    """(path, raw, doc): one row per .json file below root, path relative to it, doc a variant.

    A byte order mark is taken off; a broken file has a null doc, which validation reports.
    Rows have no order but that of ``path``. Spark's own listing leaves out files whose names
    begin with an underscore; with ``hidden`` they are listed beside it and read too. A root
    that is not there has no files.
    """
    files, base = _files(root)
    if files.get_file_info(base).type == fs.FileType.NotFound:
        return spark.createDataFrame([], "path string, raw string").withColumn("doc", F.try_parse_json("raw"))
    rows = _with_path(spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root, wholetext=True), root)
    if hidden:
        # Only names of hidden files come to the driver.
        names = [i.path for i in files.get_file_info(fs.FileSelector(base, recursive=True)) if i.base_name.startswith("_") and i.base_name.endswith(".json")]
        if names:

            def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                store, top = _files(root)
                for pdf in batches:
                    texts = [store.open_input_stream(p).read().decode("utf-8", "replace") for p in pdf["path"]]
                    yield pd.DataFrame({"path": [p[len(top.rstrip("/")) + 1 :] for p in pdf["path"]], "value": texts})

            rows = rows.unionByName(spark.createDataFrame([(n,) for n in names], "path string").mapInPandas(read, "path string, value string"))
    raw = F.regexp_replace("value", "^﻿", "")
    return rows.select("path", raw.alias("raw"), F.try_parse_json(raw).alias("doc"))


def categories(spark: SparkSession, root: str, names: tuple[str, ...] = VERIFIED_CATEGORIES, hidden: bool = True) -> DataFrame:
    """(category, path, raw, doc) of some categories, each the tree below its folder; path begins with the category."""
    out = None
    for name in names:
        one = json_tree(spark, f"{root}/{name}", hidden).select(F.lit(name).alias("category"), F.concat(F.lit(f"{name}/"), "path").alias("path"), "raw", "doc")
        out = one if out is None else out.unionByName(one)
    return out


def candidates(spark: SparkSession, root: str, category: str, manufacturer: str | None = None) -> DataFrame:
    """(path, raw, doc) to be filled from sources: no hidden files, of one maker's folder where given; only it is listed."""
    below = f"{category}/{manufacturer}" if manufacturer else category
    return json_tree(spark, f"{root}/{below}", hidden=False).withColumn("path", F.concat(F.lit(f"{below}/"), "path"))


def curated_slugs(spark: SparkSession, root: str, category: str, manufacturer: str | None = None) -> DataFrame:
    """(slug) of all readable documents of a category or maker; slugs that are no texts do not count."""
    docs = json_tree(spark, f"{root}/{category}/{manufacturer}" if manufacturer else f"{root}/{category}")
    kind = F.schema_of_variant(F.try_variant_get("doc", "$.slug", "variant"))
    return docs.where(kind == "STRING").select(F.try_variant_get("doc", "$.slug", "string").alias("slug")).distinct()


def changed_paths(spark: SparkSession, repository: str, base: str = "origin/main", below: str = "data/") -> DataFrame:
    """(path) of documents that differ from a base commit, relative to the data folder; a repository without the base has none."""
    run = subprocess.run(["git", "-C", repository, "diff", "--name-only", base, "HEAD", "--", below], capture_output=True, text=True, check=False)
    names = [line[len(below) :] for line in run.stdout.splitlines() if line.startswith(below) and line.endswith(".json")] if run.returncode == 0 else []
    return spark.createDataFrame([(n,) for n in names], "path string")


def override_map(spark: SparkSession, path: str) -> DataFrame:
    """(name, id) of a JSON object of names and ids."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("name", "id"))


def with_typed_dates(df: DataFrame) -> DataFrame:
    """Text columns named *_date become dates; impossible ones are null."""
    return df.withColumns({c: F.try_to_date(F.col(c), "yyyy-MM-dd") for c, t in df.dtypes if c.endswith("_date") and t == "string"})


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with blank lines left out and their order kept in ``line_no``."""
    df = spark.read.text(path).where(F.trim("value") != "")
    return df.withColumn("line_no", F.monotonically_increasing_id()).select("line_no", F.from_json("value", schema).alias("r")).select("line_no", "r.*")


def zipped_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line): the lines of the first .jsonl member of each zip archive."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    member = next((n for n in z.namelist() if n.endswith(".jsonl")), None)
                    if member:
                        with z.open(member) as f:
                            batch: list[str] = []
                            for raw in io.TextIOWrapper(f, "utf-8"):
                                if raw.strip():
                                    batch.append(raw.rstrip("\n"))
                                if len(batch) >= 4096:
                                    yield pd.DataFrame({"line": batch})
                                    batch = []
                            yield pd.DataFrame({"line": batch}, columns=["line"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(lines, "line string")
