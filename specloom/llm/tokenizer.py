"""Encoding a whole corpus with a public byte-level BPE tokenizer.

Texts longer than CHUNK characters are cut into overlapping chunks, each pre-tokenised by
itself. Neighbouring chunks are stitched where their pre-token boundaries meet again, and
the pieces between such points are encoded. A pre-token depends on nothing to its left, so
from a common boundary on both chunks' pre-tokens are the same and a piece's ids are those
of the whole. A pair of chunks without a common boundary becomes one chunk and is
pre-tokenised anew. A text of up to SPREAD characters is worked on in one task; the chunks
of a longer one go to many tasks. Null and empty texts have no ids.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from specloom.session import cut

#: Folder of the public vocabularies; a parameter, as the files are not part of this package.
TOKENIZER_DIR = os.environ.get("SPECLOOM_TOKENIZERS", "/opt/tokenizers")
TOKENIZER = "byte_bpe_50k"
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of a chunk within a task and of what it shares with the next.
CHUNK = 1024
OVERLAP = 128
#: Texts over this many characters are spread over tasks, in chunks of this size.
SPREAD = 65536
SPREAD_OVERLAP = 2048

_CACHE: dict[str, object] = {}


def rank_file(name: str = TOKENIZER, folder: str | None = None) -> str:
    return f"{folder or TOKENIZER_DIR}/{name}.tiktoken"


def encoding(path: str):
    """The tokenizer of a rank file, loaded once per Python worker."""
    if path not in _CACHE:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _CACHE[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _CACHE[path]


def pretoken_starts(text: str) -> list[int]:
    """Where pre-tokens start. In a chunk the last start holds, what follows it does not."""
    import regex

    if "pattern" not in _CACHE:
        _CACHE["pattern"] = regex.compile(PATTERN)
    return [m.start() for m in _CACHE["pattern"].finditer(text)]


def stitched(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """Pieces of a text whose ids concatenate to the text's ids."""
    cuts, begin, end = [0], 0, chunk
    known = pretoken_starts(text[: chunk + overlap])
    while end < len(text):
        after = [end + x for x in pretoken_starts(text[end : end + chunk + overlap])]
        shared = {x for x in known if x >= end and not text[x - 1].isspace()}
        common = next((x for x in after if x < end + overlap and x in shared), None)
        if common is None:
            end += chunk
            known = [begin + x for x in pretoken_starts(text[begin : end + overlap])]
        else:
            cuts.append(common)
            begin, end, known = end, end + chunk, after
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


def encode_texts(texts: list[str | None], path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[list[int]]:
    """Ids of texts without special tokens; strings that look like special tokens are ordinary text."""
    enc = encoding(path)
    whole = enc.encode_ordinary
    return [[] if not t else whole(t) if len(t) <= chunk else [i for piece in stitched(t, chunk, overlap) for i in whole(piece)] for t in texts]


def decode_ids(ids: list[int], path: str) -> bytes:
    """The raw bytes of ids, concatenated."""
    enc = encoding(path)
    return b"".join(enc.decode_single_token_bytes(i) for i in ids)


def _encode(df: DataFrame, key: str, counts: bool, path: str, chunk: int, overlap: int) -> DataFrame:
    """Column ``_text`` replaced by ids or their number."""
    kind = pa.int64() if counts else pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, names = batch.column("_text"), [n for n in batch.schema.names if n != "_text"]
            for at in range(0, batch.num_rows, 1024):  # bounds what one batch holds in Python
                ids = encode_texts(text.slice(at, 1024).to_pylist(), path, chunk, overlap)
                values = pa.array([len(x) for x in ids] if counts else ids, kind)
                yield pa.RecordBatch.from_arrays([*[batch.column(n).slice(at, 1024) for n in names], values], [*names, key])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != "_text")
    return df.mapInArrow(run, f"{kinds}, {key} {'bigint' if counts else 'array<int>'}")


def pieces(texts: DataFrame, chunk: int = SPREAD, overlap: int = SPREAD_OVERLAP) -> DataFrame:
    """(key, at, _text): pieces of texts (key, text) whose ids concatenate to the text's ids.

    ``key`` is unique and not null. Every round pre-tokenises the chunks of the texts still
    open in parallel; a text in which two neighbours have no common boundary goes into the
    next round with those two as one chunk.
    """

    def starts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            head, tail = [], []
            for at, until, text in zip(pdf["at"], pdf["until"], pdf["piece"]):
                s = [int(at) + x for x in pretoken_starts(text)]
                head.append([x for x in s if x < at + overlap])
                tail.append([x for x in s if x >= until and not text[x - at - 1].isspace()])
            yield pdf[["key", "at", "until"]].assign(head=head, tail=tail)

    c = F.col
    n = F.length("text")
    even = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / chunk).cast("int")), lambda i: F.struct((i * chunk).alias("at"), F.least((i + 1) * chunk, n).alias("until")))
    open_, done = texts.select("key", "text", even.alias("spans")), None
    w = Window.partitionBy("key").orderBy("at")
    while True:
        cuts = F.transform("spans", lambda s: F.struct(s["at"].alias("at"), s["until"].alias("until"), F.substr("text", s["at"] + 1, s["until"] - s["at"] + overlap).alias("piece")))
        bounds = open_.select("key", F.explode(cuts).alias("c")).select("key", "c.*").repartition("key", "at").mapInPandas(starts, "key string, at int, until int, head array<int>, tail array<int>")
        common = F.when(c("at") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("head", F.lag("tail").over(w))))
        found = bounds.select("key", "at", "until", common.alias("common"))
        found = cut(found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "until", "common"))).alias("chunks")), "tokenizer-bounds")
        whole = ~F.exists("chunks", lambda x: x["common"].isNull())
        good = found.where(whole).select("key", F.transform("chunks", lambda x: x["common"]).alias("cuts"))
        done = good if done is None else done.unionByName(good)
        if found.where(~whole).isEmpty():
            break
        # A chunk without a common boundary goes to the one before it.
        span = lambda a, b: F.struct(a.alias("at"), b.alias("until"))
        none = F.array().cast("array<struct<at:int,until:int>>")
        merged = F.reduce("chunks", none, lambda acc, x: F.when(x["common"].isNull(), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(span(F.element_at(acc, -1)["at"], x["until"])))).otherwise(F.concat(acc, F.array(span(x["at"], x["until"])))))
        open_ = texts.join(found.where(~whole).select("key", merged.alias("spans")), "key")
    ranges = F.transform("cuts", lambda x, i: F.struct(x.alias("at"), F.coalesce(F.get("cuts", i + 1), F.lit(2**31 - 1)).alias("until")))
    return texts.join(done.select("key", F.explode(ranges).alias("r")), "key").select("key", c("r.at").alias("at"), F.substr("text", c("r.at") + 1, c("r.until") - c("r.at")).alias("_text"))


def encode_corpus(documents: DataFrame, path: str | None = None, counts: bool = False, chunk: int = CHUNK, overlap: int = OVERLAP, spread: int = SPREAD, spread_overlap: int = SPREAD_OVERLAP, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, ids) of every document, or (doc_id, *keep, tokens) with their number.

    Null and empty texts have an empty list, or 0. Each row gives a row, whatever its length:
    a repeated or null doc_id is no key. Texts over ``spread`` characters are worked on once
    per distinct text, under its SHA-256, and joined back by it.
    """
    path, key = path or rank_file(), "tokens" if counts else "ids"
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), *keep, "text")
    short = F.coalesce(F.length("text") <= spread, F.lit(True))
    whole = _encode(docs.where(short).select("doc_id", *keep, F.col("text").alias("_text")), key, counts, path, chunk, overlap)
    long_docs = cut(docs.where(~short).withColumn("key", F.sha2("text", 256)), "tokenizer-long")
    if long_docs.isEmpty():
        return whole
    texts = long_docs.select("key", "text").dropDuplicates(["key"])
    parts = _encode(pieces(texts, spread, spread_overlap).repartition("key", "at"), key, counts, path, chunk, overlap)
    if counts:
        done = parts.groupBy("key").agg(F.sum(key).alias(key))
    else:
        ordered = F.array_sort(F.collect_list(F.struct("at", key)))
        done = parts.groupBy("key").agg(F.flatten(F.transform(ordered, lambda x: x[key])).alias(key))
    return whole.unionByName(long_docs.drop("text").join(done, "key").select("doc_id", *keep, key))


def decode_corpus(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, data): the raw bytes of every id list."""
    path = path or rank_file()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [decode_ids(x or [], path) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, data binary")
