"""Record operators: first and last of a key, filling nulls, ranks, outliers, pages."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specloom.functions.mathx import py_round
from specloom.session import cut


def last_by_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """One row per key, the last in order; a single aggregation, no sort of the rows."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def first_by_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def fill_nulls(df: DataFrame, found: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left join that fills nulls and never overwrites; ``outcome`` says what happened."""
    other = found.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = df.join(other, key, "left")
    empty = lambda c: F.col(c).isNull()
    had_all, can = F.lit(True), F.lit(False)
    for c in columns:
        had_all, can = had_all & ~empty(c), can | (empty(c) & F.col(f"_{c}").isNotNull())
    outcome = F.when(had_all, "already").when(can, "filled").otherwise("unresolved")
    return joined.withColumn("outcome", outcome).withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop(*[f"_{c}" for c in columns])


#: Accuracy of the sketch that brackets a rank; ranks are exact whatever it is.
SKETCH = 10_000


def order_statistics(df: DataFrame, by: list[str], value: str, ranks: dict[str, tuple[float, Callable[[Column], Column]]], written: bool = False) -> DataFrame:
    """(*by, n, names ...): exact values at ranks of each group, without sorting a group in one task.

    ``ranks`` maps a name to (its share of the group, its 0-based rank as a column of n). In
    a large group a sketch brackets each rank by two values; what lies below a bracket is
    only counted, what lies in it is counted per value, and of these few the one that covers
    the rank is picked. Values are read twice and therefore written once, unless ``df`` is
    a table (``written``). Null values do not count; groups without others give no row.
    """
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    rows = rows if written else cut(rows, "values")
    slack = 3.0 / SKETCH
    ends = [max(0.0, min(1.0, share + d)) for share, _ in ranks.values() for d in (-slack, slack)]
    sketch = rows.groupBy(*[F.col(b).alias(f"_{b}") for b in by]).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_v", ends, SKETCH).alias("_e"))
    large = F.col("n") > 10 * SKETCH  # a bracket is then wider than what rounding a rank may do
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), rank(F.col("n")).alias("rank"), F.when(large, F.get("_e", F.lit(2 * i))).alias("lo"), F.when(large, F.get("_e", F.lit(2 * i + 1))).alias("hi")) for i, (name, (_, rank)) in enumerate(ranks.items())])
    same = reduce(lambda x, y: x & y, [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by])
    told = rows.join(sketch, same).select(*by, "n", "_v", F.explode(wanted).alias("s")).where("s.hi is null or _v <= s.hi")
    counted = told.groupBy(*by, "n", "s.name", "s.rank", F.when(F.col("s.lo").isNull() | (F.col("_v") >= F.col("s.lo")), F.col("_v")).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(*by, "name").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    found = counted.withColumn("_upto", F.sum("_c").over(upto)).where("_upto > rank").groupBy(*by, "n", "name").agg(F.min("_v").alias("_v"))
    return found.groupBy(*by, "n").agg(*[F.max(F.when(F.col("name") == name, F.col("_v"))).alias(name) for name in ranks])


def medians(df: DataFrame, by: list[str], value: str, out: str = "median", written: bool = False) -> DataFrame:
    """(*by, n, median): the mean of the two middle values of each group, exactly."""
    half = lambda n, up: F.floor((n - 1 + up) / 2).cast("bigint")
    found = order_statistics(df, by, value, {"_low": (0.5, lambda n: half(n, 0)), "_high": (0.5, lambda n: half(n, 1))}, written)
    return found.select(*by, "n", ((F.col("_low") + F.col("_high")) / 2).alias(out))


def rank_bounds(df: DataFrame, by: list[str], value: str, lo: float = 1.0, hi: float = 99.0, least: int = 5) -> DataFrame:
    """Nearest-rank bounds per group of at least ``least`` values: index round-half-even(p/100 (n-1))."""
    at = lambda p: (p / 100.0, lambda n: F.bround(F.lit(p / 100.0) * (n - 1), 0).cast("bigint"))
    return order_statistics(df, by, value, {"lo": at(lo), "hi": at(hi)}).where(F.col("n") >= least)


def mad_outliers(df: DataFrame, key: list[str], ratio: Column, by: list[str], k: float = 4.0, least: int = 8) -> DataFrame:
    """Rows whose log ratio lies more than k median deviations off the median of their group, with log ratio and ratio."""
    rows = cut(df.where(ratio > 0).select(*key, *[c for c in by if c not in key], F.ln(ratio).alias("_r")), "ratios")
    mid = medians(rows, by, "_r", "_m", written=True).withColumnRenamed("n", "_n")
    dev = cut(rows.join(mid, by).withColumn("_d", F.abs(F.col("_r") - F.col("_m"))), "deviations")
    mad = medians(dev, by, "_d", "_mad", written=True).drop("n")
    out = dev.join(mad, by).where((F.col("_n") >= least) & (F.col("_d") > k * F.when(F.col("_mad") == 0, 1e-9).otherwise(F.col("_mad"))))
    return out.select(*key, *[c for c in by if c not in key], py_round(F.col("_r"), 4).alias("log_ratio"), py_round(F.exp("_r"), 2).alias("ratio"))


def page(df: DataFrame, order: list[Column], offset: int = 0, limit: int = 20) -> DataFrame:
    """One page under a total order; limit 1 to 100, offset 0 or more."""
    if not 1 <= limit <= 100 or offset < 0:
        raise ValueError("limit must be 1 to 100 and offset 0 or more")
    return df.orderBy(*order).offset(offset).limit(limit)


def page_links(count: int, path: str, filters: dict[str, str], offset: int = 0, limit: int = 20) -> dict:
    """The envelope of a page: count, next and previous addresses."""

    def link(at: int) -> str:
        parts = [f"{k}={v}" for k, v in filters.items()] + [f"offset={at}"] + ([f"limit={limit}"] if limit != 20 else [])
        return f"{path}?{'&'.join(parts)}"

    return {"count": count, "next": link(offset + limit) if offset + limit < count else None, "previous": link(max(offset - limit, 0)) if offset > 0 else None}
