"""Deduplicating new batches against all history without reprocessing it.

State is a folder of tables, one partition per turn (one batch, or some that were waiting
together) and, but for ``members``, per bucket of blocks: ``members`` (rows with their parsed fields and class), ``classes`` (distinct
spellings of products), ``keys`` (blocking keys, each with every class that has it),
``clusters`` (class to representative, the latest entry counts), ``weights`` and ``done``.
A linker that opens the folder goes on where the last one stopped, whatever process that
was; a batch counts once it is in ``done``, so a turn that broke off is taken in again.

A batch is parsed, folded to classes, new classes probe the keys of their buckets, pairs
are scored with learned weights, and only clusters that a pair touches get new entries.
Pairs and clusters never leave a block, so no bucket is read that the batch does not touch.
A class is named by its first row, and a cluster by its first class: the row that brought
the product first, as ids rise with batches.

A block is what must agree exactly (category, maker, model code, suffix, memory): makers
share families, so a family and a number say nothing without the maker. A key is a block
with one spelling of the family less at most one letter, which spellings one slip apart
share; how name and slug spell the family decides by weights. A class is compared with
every class of its keys; copies are one class, so pairs grow with the distinct spellings
of a key and not with its rows.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from specloom.functions.text import fold_ascii
from specloom.llm.product_names import maker_key, one_slip, with_product
from specloom.session import cut, shared_path

FIELDS = ("category", "maker", "code", "suffix", "memory", "family", "stem")
#: Comparison fields and their levels, for the weights.
LEVELS = {"family": 3, "stem": 3}
BLOCK = ("category", "maker", "code", "suffix", "memory")
#: Buckets of blocks; a batch of few rows reads few of them.
BUCKETS = 16
#: Waiting batches are taken in together up to this many rows a turn.
TURN_ROWS = 1_000_000


def product_rows(batch: DataFrame, *keep: str) -> DataFrame:
    """(ingest_id, fields ..., *keep) of candidate rows, parsed from record and slug.

    A row whose name has no number of three digits falls back on its slug if that has one;
    without a name or slug it is a product of its own (its code is its id). Nulls become ''.
    """
    c, blank = F.col, lambda x: F.coalesce(x, F.lit(""))
    rows = batch.where("ingest_id is not null").select(
        c("ingest_id").cast("bigint").alias("ingest_id"),
        F.lower(F.trim("category")).alias("category"),
        F.regexp_replace(F.lower("slug"), r"-(\d+(?:st|nd|rd|th)-)?entry$", "").alias("slug"),
        F.col("manufacturer").alias("given"),
        F.from_json("record", "name string, manufacturer string, ram_gb string, storage_options_gb string").alias("r"),
        *keep,
    )
    words, long = F.regexp_replace("slug", "[-_]+", " "), r"\d{3}"
    rows = with_product(rows, F.when(c("r.name").rlike(long), c("r.name")).when(words.rlike(long), words).otherwise(F.coalesce(F.nullif(F.trim("r.name"), F.lit("")), words)))
    storage = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(blank(c("r.storage_options_gb")), F.lit(r"(\d+)"), 1), lambda x: x.cast("bigint"))))
    memory = F.when(c("category") == "smartphone", F.concat(F.regexp_extract(blank(c("r.ram_gb")), r"(\d+)", 1), F.lit("/"), F.array_join(storage.cast("array<string>"), ",")))
    letters = F.regexp_replace(F.regexp_replace(fold_ascii(c("slug")), r"\d+\s?gb\b", " "), r"[^a-z]+", " ")
    rows = rows.withColumn("maker", blank(F.coalesce(maker_key(c("given")), maker_key(c("r.manufacturer")), c("p.maker")))).withColumn("words", F.split(letters, " "))
    # The longest word of a slug that is not the maker is the family, perhaps with a letter run on.
    stem = F.reduce("words", F.lit(""), lambda acc, w: F.when((F.length(w) > F.length(acc)) & (F.length(w) > 3) & (w != c("maker")), w).otherwise(acc))
    return rows.select(
        "ingest_id",
        blank(c("category")).alias("category"),
        "maker",
        F.coalesce("p.code", F.concat(F.lit("#"), c("ingest_id").cast("string"))).alias("code"),
        blank(c("p.suffix")).alias("suffix"),
        blank(memory).alias("memory"),
        blank(c("p.family")).alias("family"),
        blank(stem).alias("stem"),
        *keep,
    )


#: Families of this many letters and more are keyed by their ends: one slip leaves one of them whole.
LONG = 64


def spellings(family: Column, stem: Column) -> Column:
    """The family, the family less any one letter, and the slug's stem; of a long family its two ends."""
    less = F.transform(F.sequence(F.lit(1), F.greatest(F.length(family), F.lit(1))), lambda i: F.concat(F.substr(family, F.lit(1), i - 1), F.substr(family, i + 1)))
    none = F.array().cast("array<string>")
    less = F.when(F.length(family) <= LONG, less).otherwise(none)
    ends = F.when(F.length(family) >= LONG, F.array(F.concat(F.lit("^"), F.left(family, F.lit(LONG // 2))), F.concat(F.lit("$"), F.right(family, F.lit(LONG // 2))))).otherwise(none)
    return F.array_distinct(F.concat(F.array(family), less, ends, F.filter(F.array(stem), lambda s: s != "")))


def key_rows(classes: DataFrame) -> DataFrame:
    """One row per class and blocking key; ``key`` and ``check`` are two hashes of block and spelling."""
    return classes.withColumn("spelling", F.explode(spellings(F.col("family"), F.col("stem")))).select(
        "bucket", F.xxhash64(*BLOCK, "spelling").alias("key"), F.xxhash64("spelling", *reversed(BLOCK)).alias("check"), (F.col("spelling") == F.col("family")).alias("whole"), "node", "family", "stem"
    )


def levels(a: str, b: str) -> list[Column]:
    """Agreement per comparison field: the higher the better."""
    c = lambda side, n: F.col(f"{side}.{n}")
    words = lambda x, y: F.when((x == "") | (y == ""), 0).when(x == y, 2).when(one_slip(x, y), 1).otherwise(0)
    text = lambda n: words(c(a, n), c(b, n))
    # A slip in one spelling may be absent from the other spelling of the same row.
    across = F.greatest(text("family"), words(c(a, "family"), c(b, "stem")), words(c(a, "stem"), c(b, "family")))
    return [across.alias("family"), text("stem").alias("stem")]


@dataclass
class Weights:
    """log2 m/u per field and level, and the log2 prior odds of a pair."""

    by_level: dict[str, list[float]]
    prior: float

    def score(self, level: dict[str, Column]) -> Column:
        total = F.lit(self.prior)
        for field, w in self.by_level.items():
            one = F.lit(w[0])
            for i in range(1, len(w)):
                one = F.when(level[field] == i, F.lit(w[i])).otherwise(one)
            total = total + one
        return total


#: Where no history pairs exist to learn from.
DEFAULT = Weights({"family": [-4.0, 1.5, 2.0], "stem": [-1.0, 0.5, 0.5]}, 0.0)


def learn(shared: list[dict], random: list[dict], rounds: int = 60) -> Weights:
    """Fellegi-Sunter weights over counted agreement patterns.

    ``random`` are pairs of different blocks and give u; ``shared`` are pairs with a
    blocking key in common and give m and the prior, by expectation maximisation with u
    fixed. Each has at most 9 rows (levels and n), whatever the size of the history.
    """
    total = sum(r["n"] for r in shared)
    if total < 50 or sum(r["n"] for r in random) < 50:
        return DEFAULT

    def rates(rows: list[tuple[dict, float]]) -> dict[str, list[float]]:
        counts = {f: [0.5] * k for f, k in LEVELS.items()}
        for r, n in rows:
            for f in LEVELS:
                counts[f][r[f]] += n
        return {f: [x / sum(v) for x in v] for f, v in counts.items()}

    u = rates([(r, r["n"]) for r in random])
    m, p = {f: [0.1 / (k - 1)] * (k - 1) + [0.9] for f, k in LEVELS.items()}, 0.5
    for _ in range(rounds):
        soft = []
        for r in shared:
            a, b = p, 1 - p
            for f in LEVELS:
                a *= m[f][r[f]]
                b *= u[f][r[f]]
            soft.append((r, r["n"] * (a / (a + b) if a + b else 0.5)))
        p = min(max(sum(n for _, n in soft) / total, 1e-4), 1 - 1e-4)
        m = rates(soft)
    return Weights({f: [math.log2(a / b) for a, b in zip(m[f], u[f])] for f in LEVELS}, math.log2(p / (1 - p)))


def counted(pairs: DataFrame) -> list[dict]:
    return [r.asDict() for r in pairs.groupBy(*LEVELS).agg(F.count(F.lit(1)).alias("n")).collect()]


def random_pairs(classes: DataFrame) -> DataFrame:
    """Levels of every class against a class of another block: the first of some hash slot of its category."""
    slot = lambda salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(64))
    first = classes.groupBy("category", slot(1).alias("slot")).agg(F.min(F.struct("node", *BLOCK, "family", "stem")).alias("y"))
    rows = classes.select("category", slot(2).alias("slot"), F.struct("node", *BLOCK, "family", "stem").alias("x"))
    other = F.lit(False)
    for n in BLOCK:
        other = other | (F.col(f"x.{n}") != F.col(f"y.{n}"))
    return rows.join(first, ["category", "slot"]).where(other).select(*levels("x", "y"))


def _observed(df: DataFrame, condition: Column, path: str) -> tuple[DataFrame, int]:
    """Write a table and count, in the same job, its rows of a condition."""
    seen = Observation()
    df.observe(seen, F.count_if(condition).alias("n")).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["n"]


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): the least node of each node's connected component.

    ``edges`` (a, b) hold both directions. Labels go to the least neighbour's label and
    then to that label's own label, so the rounds are logarithmic in the length of a
    chain; each round is a written table, and the last one changed nothing.
    """
    spark = edges.sparkSession
    labels = cut(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), label)
    changed = 1
    while changed:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m"))
        step = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
        step = step.join(up, "root", "left").select("node", "old", F.least("root", "up").alias("root"))
        step, changed = _observed(step, F.col("old") != F.col("root"), shared_path(spark, label))
        labels = step.select("node", "root")
    return labels


class Linker:
    """The state in a folder and the way a batch goes into it."""

    _FIELDS = ", ".join(f"{f} string" for f in FIELDS)
    TABLES = {
        "members": f"ingest_id bigint, class string, {_FIELDS}, bucket int",
        "classes": f"class string, node bigint, {_FIELDS}, bucket int",
        "keys": "key bigint, check bigint, whole boolean, node bigint, family string, stem string, bucket int",
        "clusters": "node bigint, root bigint, at int, bucket int",
        "weights": "weights string",
        "done": "batch int, turn int",
    }

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS) -> None:
        """Opens the state below ``path``, or a fresh one; ``buckets`` stays as it was first given."""
        self.spark, self.path, self.buckets = spark, path or shared_path(spark, "dedup"), buckets
        done = self._stored("done") if path else []
        self.done, self.turns = {r["batch"] for r in done}, 1 + max((r["turn"] for r in done), default=-1)
        stored = self._stored("weights") if path else []
        self.weights = Weights(**json.loads(stored[0]["weights"])) if stored else None

    def _stored(self, name: str) -> list:
        """The rows of a small table that may not be there yet."""
        try:
            return self.spark.read.schema(self.TABLES[name]).parquet(f"{self.path}/{name}").collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise

    def table(self, name: str, buckets: list[int] | None = None, more: int = 0) -> DataFrame:
        """A table of the turns done (and ``more`` after them), of some buckets where given."""
        columns = [c.split()[0] for c in self.TABLES[name].split(", ")]
        if not self.turns + more:
            return self.spark.createDataFrame([], self.TABLES[name])
        df = self.spark.read.schema(self.TABLES[name]).option("basePath", f"{self.path}/{name}").parquet(*[f"{self.path}/{name}/turn={t}" for t in range(self.turns + more)]).select(*columns)
        return df if buckets is None else df.where(F.col("bucket").isin(buckets))

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        """This turn's part of a table; a turn that is tried again replaces what its first try left."""
        path = f"{self.path}/{name}/turn={self.turns}"
        df.select(*[c.split()[0] for c in self.TABLES[name].split(", ")]).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        return self.spark.read.schema(self.TABLES[name]).parquet(path)

    def parse(self, batch: DataFrame, *keep: str) -> DataFrame:
        """Rows as ``members`` holds them."""
        rows = product_rows(batch, *keep)
        bucket = F.pmod(F.xxhash64(F.concat_ws("|", *BLOCK)), F.lit(self.buckets)).cast("int")
        return rows.select("ingest_id", F.md5(F.concat_ws("\u001f", *FIELDS)).alias("class"), *FIELDS, bucket.alias("bucket"), *keep)

    def accept(self, batch: DataFrame, number: int) -> None:
        """Take in one batch; one already taken in is left as it is."""
        if number not in self.done:
            self.take(self.parse(batch), [number])

    def take(self, parsed: DataFrame, numbers: list[int]) -> None:
        """Take in parsed rows of batches as one turn."""
        spark, path = self.spark, f"{self.path}/members/turn={self.turns}"
        parsed.select(*[c.split()[0] for c in self.TABLES["members"].split(", ")]).write.mode("overwrite").parquet(path)
        rows = spark.read.schema(self.TABLES["members"]).parquet(path)
        folded = rows.groupBy("class", "bucket").agg(F.min("ingest_id").alias("node"), *[F.any_value(f).alias(f) for f in FIELDS])
        # At most ``buckets`` rows.
        touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())
        new = self._write(folded.join(self.table("classes", touched).select("class"), "class", "left_anti") if self.turns else folded, "classes")
        brought = self._write(key_rows(new), "keys")
        side = lambda df, n: df.select("key", "check", "whole", "bucket", F.struct("node", "family", "stem").alias(n))
        pairs = (
            side(brought, "x")
            .join(side(self.table("keys", touched, 1), "y").drop("whole", "bucket"), ["key", "check"])
            # Equal families share all their keys; the whole one is enough.
            .where("x.node <> y.node and (x.family <> y.family or whole)")
            .select("bucket", F.col("x.node").alias("a"), F.col("y.node").alias("b"), *levels("x", "y"))
        )
        if self.weights is None:
            pairs = cut(pairs, "dedup-pairs")
            self.weights = learn(counted(pairs), counted(random_pairs(new)))
            spark.createDataFrame([(json.dumps(asdict(self.weights)),)], self.TABLES["weights"]).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/weights")
        # Posterior odds of at least one to one; what a block holds agrees by the key.
        linked = pairs.where(self.weights.score({f: F.col(f) for f in LEVELS}) >= 0).select("bucket", "a", "b").distinct()
        if self.turns:
            linked = linked.join(self.clusters(touched).select(F.col("node").alias("b"), "root"), "b", "left").select("bucket", "a", F.coalesce("root", "b").alias("b")).where("a <> b")
        edges = cut(linked.union(linked.select("bucket", F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "dedup-edges")
        moved = components(edges, "dedup-labels").where("node <> root").join(edges.select(F.col("a").alias("node"), "bucket").distinct(), "node").select("node", "root", "bucket")
        if self.turns:
            # Classes below a representative that moved go with it.
            moved = moved.union(self.clusters(touched).withColumnRenamed("root", "old").join(moved.select(F.col("node").alias("old"), "root"), "old").select("node", "root", "bucket"))
        self._write(moved.withColumn("at", F.lit(self.turns)), "clusters")
        spark.createDataFrame([(n, self.turns) for n in numbers], self.TABLES["done"]).coalesce(1).write.mode("append").parquet(f"{self.path}/done")
        self.done |= set(numbers)
        self.turns += 1

    def clusters(self, buckets: list[int] | None = None) -> DataFrame:
        """(node, root, bucket) of classes that are not their own representative."""
        return self.table("clusters", buckets).groupBy("node", "bucket").agg(F.max_by("root", "at").alias("root")).select("node", "root", "bucket")

    def representatives(self) -> DataFrame:
        """(ingest_id, first_id) of every row taken in."""
        roots = self.table("classes").select("class", "node").join(self.clusters().select("node", "root"), "node", "left").select("class", F.coalesce("root", "node").alias("first_id"))
        return self.table("members").select("ingest_id", "class").join(roots, "class").select("ingest_id", "first_id")


def link_batches(candidates: DataFrame, path: str | None = None, turn_rows: int = TURN_ROWS) -> DataFrame:
    """All rows through the linker in order of their batches: (ingest_id, first_id).

    Rows are parsed once. The first batch ever is the history that weights are learned
    from; later ones that are waiting are taken in together up to ``turn_rows`` rows (0:
    one by one), with the result they would give one by one. One row per batch number comes
    to the driver; rows without a number count as the last batch. Repeated ids count once.
    With the ``path`` of an earlier run only batches it has not seen are taken in.
    """
    spark = candidates.sparkSession
    last = 2**31 - 1
    linker = Linker(spark, path)
    rows = linker.parse(candidates.withColumn("batch", F.coalesce(F.col("batch_no").cast("int"), F.lit(last))), "batch")
    if linker.done:
        rows = rows.where(~F.col("batch").isin(sorted(linker.done)))
    staged = shared_path(spark, "dedup-staged")
    rows.hint("rebalance", "batch").write.partitionBy("batch").parquet(staged)
    every = spark.read.schema(Linker.TABLES["members"] + ", batch int").parquet(staged)
    turn, size = [], 0
    for number, n in [*((r["batch"], r["count"]) for r in every.groupBy("batch").count().orderBy("batch").collect()), (None, 0)]:
        if turn and (number is None or not linker.turns or size + n > turn_rows):
            linker.take(every.where(F.col("batch").isin(turn)), turn)
            turn, size = [], 0
        turn.append(number)
        size += n
    return linker.representatives().distinct()
