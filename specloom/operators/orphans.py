"""References to records that do not exist.

State is kept in a folder: ``rows`` holds the counting version of every row seen, one
part per turn, and ``counts`` the signed changes of reference and existence counts per key
and time that each turn brought. A turn compares the rows it touches with what the state
holds of them and writes the differences: the new version's keys with +1, the superseded
version's with -1, whenever that one came. Sums over the turns are the counts; a key with
positive references and no existence is an orphan. Reports need counts only; the list
of referring rows joins the rows to the times from which keys exist.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions.text import trim_all
from specloom.session import cut, shared_path


@dataclass(frozen=True)
class Source:
    """A table of row versions: what its rows refer to and what their existence stands for.

    ``refers`` maps a field to (target, key) and ``exists`` a target to a key. Rows that are
    not ``live`` neither refer nor exist. ``created_at`` is the time of both.
    """

    name: str
    changes: DataFrame
    refers: dict[str, tuple[str, Column]] = field(default_factory=dict)
    exists: dict[str, Column] = field(default_factory=dict)
    live: Column | None = None
    row_id: str = "id"
    version: str = "updated_at"


def id_key(c: Column) -> Column:
    """Numeric key as text; 0 and negative numbers are keys."""
    return c.cast("string")


def slug_key(c: Column) -> Column:
    """Slug without outer blanks and case; blank gives null."""
    k = F.lower(trim_all(c))
    return F.when(k != "", k)


_KEY = "struct<field:string,target:string,key:string>"
ROWS = f"tbl string, row_id bigint, version timestamp_ntz, dead boolean, keys array<{_KEY}>, at timestamp_ntz"
COUNTS = "ref_table string, ref_field string, target string, key string, at timestamp_ntz, n bigint"


def latest(source: Source) -> DataFrame:
    """The greatest version of each row, by one aggregation.

    Equal versions are settled by the rest (withdrawn ones last), so repeated rows and
    their order have no effect. Rows without an id are none; null keys refer to nothing.
    """
    ref = [F.when(k.isNotNull(), F.struct(F.lit(f).alias("field"), F.lit(t).alias("target"), k.alias("key"))) for f, (t, k) in source.refers.items()]
    own = [F.when(k.isNotNull(), F.struct(F.lit(None).cast("string").alias("field"), F.lit(t).alias("target"), k.alias("key"))) for t, k in source.exists.items()]
    live = F.lit(True) if source.live is None else F.coalesce(source.live, F.lit(False))
    time = lambda c: F.col(c).cast("timestamp_ntz")
    rows = source.changes.select(F.col(source.row_id).cast("bigint").alias("row_id"), F.struct(time(source.version).alias("version"), (~live).alias("dead"), F.array_compact(F.array(*ref, *own)).cast(f"array<{_KEY}>").alias("keys"), time("created_at").alias("at")).alias("v"))
    return rows.where("row_id is not null").groupBy("row_id").agg(F.max("v").alias("v")).select(F.lit(source.name).alias("tbl"), "row_id", "v")


def signed(rows: DataFrame, sign: int) -> DataFrame:
    """Counts that rows bring: per referring field or, with a null field, existence."""
    k = rows.where("not dead").select("tbl", "at", F.explode("keys").alias("k"))
    return k.select(F.when(F.col("k.field").isNotNull(), F.col("tbl")).alias("ref_table"), F.col("k.field").alias("ref_field"), "k.target", "k.key", "at", F.lit(sign).cast("bigint").alias("n"))


def net(counts: DataFrame) -> DataFrame:
    """Sums of signed counts; those that cancel out go."""
    return counts.groupBy("ref_table", "ref_field", "target", "key", "at").agg(F.sum("n").alias("n")).where("n <> 0")


class OrphanState:
    """Reference and existence counts in a folder, kept up by turns of changes.

    The state of an earlier run is taken up again. A turn counts once it is in ``done``; one
    that broke off is written anew.
    """

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark, self.path = spark, path or shared_path(spark, "orphans")
        self.turns = 0
        if path:
            try:
                self.turns = 1 + max(r["turn"] for r in spark.read.schema("turn int").parquet(f"{path}/done").collect())
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise

    def _read(self, name: str, schema: str) -> DataFrame:
        if not self.turns:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{name}/turn={t}" for t in range(self.turns)])

    def rows(self) -> DataFrame:
        """The counting version of every row."""
        stored = self._read("rows", ROWS)
        if self.turns < 2:
            return stored
        return stored.groupBy("tbl", "row_id").agg(F.max(F.struct("version", "dead", "keys", "at")).alias("v")).select("tbl", "row_id", "v.*")

    def counts(self) -> DataFrame:
        stored = self._read("counts", COUNTS)
        return stored if self.turns < 2 else net(stored)

    def apply(self, sources: list[Source]) -> None:
        """Take in changes: any versions of any rows, in any order, as often as they come."""
        fresh = reduce(DataFrame.unionByName, [latest(s) for s in sources]).select("tbl", "row_id", "v.*")
        part = f"turn={self.turns}"
        if self.turns:
            fresh = cut(fresh, "orphans-fresh")
            held = self.rows().join(fresh.select("tbl", "row_id"), ["tbl", "row_id"], "left_semi")
            tagged = fresh.withColumn("old", F.lit(False)).unionByName(held.withColumn("old", F.lit(True)))
            v = F.struct("version", "dead", "keys", "at")
            moved = tagged.groupBy("tbl", "row_id").agg(F.max(F.when(~F.col("old"), v)).alias("new"), F.max(F.when(F.col("old"), v)).alias("was"))
            moved = cut(moved.where(F.col("was").isNull() | (F.col("new") > F.col("was"))), "orphans-moved")
            fresh = moved.select("tbl", "row_id", "new.*")
            gone = signed(moved.where("was is not null").select("tbl", "row_id", "was.*"), -1)
        fresh.write.mode("overwrite").parquet(f"{self.path}/rows/{part}")
        came = signed(self.spark.read.schema(ROWS).parquet(f"{self.path}/rows/{part}"), 1)
        net(came.unionByName(gone) if self.turns else came).write.mode("overwrite").parquet(f"{self.path}/counts/{part}")
        self.spark.createDataFrame([(self.turns,)], "turn int").coalesce(1).write.mode("append").parquet(f"{self.path}/done")
        self.turns += 1

    def since(self) -> DataFrame:
        """(target, key, since): from when on a key exists; one that exists without a time always did."""
        time = F.coalesce("at", F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))
        return self.counts().where("ref_field is null and n > 0").groupBy("target", "key").agg(F.min(time).alias("since"))

    def _orphan(self) -> Column:
        # A reference without a time needs any existence.
        return F.col("since").isNull() | (F.col("since") > F.col("at"))

    def orphans(self) -> DataFrame:
        """(ref_table, ref_field, row_id, key, at) of rows whose key does not exist at their time.

        One row per key decides; the referring rows are not grouped, so a key that a third
        of them refer to stays spread.
        """
        k = self.rows().where("not dead").select("tbl", "row_id", "at", F.explode("keys").alias("k")).where("k.field is not null")
        refs = k.select(F.col("tbl").alias("ref_table"), F.col("k.field").alias("ref_field"), "row_id", "k.target", "k.key", "at")
        return refs.join(self.since(), ["target", "key"], "left").where(self._orphan()).select("ref_table", "ref_field", "row_id", "key", "at")

    def report(self) -> DataFrame:
        """Orphan references and missing keys per table, field and month (null: no time), from counts alone."""
        return (
            self.counts().where("ref_field is not null and n > 0").join(self.since(), ["target", "key"], "left").where(self._orphan())
            .groupBy("ref_table", "ref_field", F.date_format("at", "yyyy-MM").alias("month"))
            .agg(F.sum("n").alias("orphans"), F.count_distinct("key").alias("missing_keys"))
        )

    def missing_keys(self) -> DataFrame:
        """(ref_table, ref_field, key, n): keys with references and no existence at any time."""
        return self.counts().where("ref_field is not null and n > 0").join(self.since(), ["target", "key"], "left_anti").groupBy("ref_table", "ref_field", "key").agg(F.sum("n").alias("n"))
