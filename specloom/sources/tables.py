"""Reading the catalog's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the catalog; columns are pruned and filters pushed by the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counting_rows(df: DataFrame, key: str = "id", version: str = "updated_at", *cols: str) -> DataFrame:
    """The counting row of each key: the one with the greatest version.

    Null versions lose against any other. Equal versions are settled by the remaining
    columns, so the result does not depend on the order of the rows. Rows without a key
    cannot be addressed and give no row. ``row_number() = 1`` lets Spark limit each
    group before the shuffle (WindowGroupLimit).
    """
    names = [c for c in (cols or df.columns) if c not in (key, version)]
    kept = df.select(key, version, *names).where(F.col(key).isNotNull())
    simple = [c for c, t in kept.dtypes if c in names and not t.startswith(("map", "variant"))]
    w = Window.partitionBy(key).orderBy(F.col(version).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in simple])
    return kept.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
