"""Capability scores of chips and phones and their standing within a generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specloom.functions.mathx import PHONE_SCALES, SOC_SCALES, Scale, axis, capability, combine, era_band, py_round, tier


def cohort_table(df: DataFrame, index: str, era: str = "era") -> DataFrame:
    """(era, index, percentile, cohort): one row per era and value of an index of one decimal.

    Values are counted first; an era has at most 1,001 of them, so what is cumulated is
    small however many rows an era has. Ties count as reached.
    """
    counts = df.where(F.col(index).isNotNull() & F.col(era).isNotNull()).groupBy(era, index).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(era)
    reached = F.sum("_n").over(w.orderBy(index).rowsBetween(Window.unboundedPreceding, 0))
    return counts.select(era, index, py_round(reached / F.sum("_n").over(w) * 100, 1).alias("percentile"), F.sum("_n").over(w).alias("cohort"))


def with_relative(df: DataFrame, index: str, era: str = "era", prefix: str = "") -> DataFrame:
    """Adds percentile, tier and cohort size of an index among rows of the same era.

    Rows without index or era are in no cohort and have null.
    """
    # At most 1,001 rows an era.
    known = F.broadcast(cohort_table(df, index, era).select(F.col(era).alias("_era"), F.col(index).alias("_index"), F.col("percentile").alias(f"{prefix}percentile"), F.col("cohort").alias(f"{prefix}cohort")))
    joined = df.join(known, (F.col(era) == F.col("_era")) & (F.col(index) == F.col("_index")), "left").drop("_era", "_index")
    return joined.select(*df.columns, f"{prefix}percentile", tier(F.col(f"{prefix}percentile")).alias(f"{prefix}tier"), f"{prefix}cohort")


def soc_scores(socs: DataFrame) -> DataFrame:
    """(id, slug, era, cpu_index, system_index, overall) with percentile, tier and cohort of the cpu and the system index."""
    c = F.col
    scored = socs.select("id", "slug", era_band(c("release_date")).alias("era"), *[capability(c(n), SOC_SCALES[n]).alias(n) for n in ("geekbench_single", "geekbench_multi", "antutu_score")])
    scored = scored.select("id", "slug", "era", combine([(c("geekbench_single"), 0.4), (c("geekbench_multi"), 0.6)]).alias("cpu_index"), c("antutu_score").alias("system_index"))
    scored = scored.withColumn("overall", combine([(c("cpu_index"), 0.7), (c("system_index"), 0.3)]))
    return with_relative(with_relative(scored, "cpu_index", prefix="cpu_"), "system_index", prefix="system_")


def chain_scores(parts: DataFrame, chains: dict[str, list[str]], scales: dict[str, Scale], weights: dict[str, float]) -> DataFrame:
    """Axes of parts by the first benchmark of each chain that is there, and their weighted mean.

    ``parts`` have id, slug, release_date and any of the benchmarks; those it lacks count as
    absent. Each axis has index, source, percentile, tier and cohort.
    """
    base = parts.withColumn("era", era_band(F.col("release_date")))
    for dim, chain in chains.items():
        base = base.withColumn(f"_{dim}", axis([(F.col(n), scales[n], n) for n in chain if n in parts.columns]))
    scored = base.select("id", "slug", "era", *[c for dim in chains for c in (F.col(f"_{dim}.index").alias(f"{dim}_index"), F.col(f"_{dim}.source").alias(f"{dim}_source"))])
    scored = scored.withColumn("overall", combine([(F.col(f"{dim}_index"), weights[dim]) for dim in chains]))
    for dim in chains:
        scored = with_relative(scored, f"{dim}_index", prefix=f"{dim}_")
    return scored


def cohort_stats(dimensions: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(dimension, era, cohort, best, middle) over the cohorts of all dimensions: their size, top and lower median index."""
    out = None
    for name, (df, index) in dimensions.items():
        t = cohort_table(df, index)
        middle = F.min(F.when(F.col("percentile") >= 50.0, F.col(index)))
        one = t.groupBy("era").agg(F.max("cohort").alias("cohort"), F.max(index).alias("best"), middle.alias("middle")).select(F.lit(name).alias("dimension"), "era", "cohort", "best", "middle")
        out = one if out is None else out.unionByName(one)
    return out


def camera_score(cameras: Column, main: Column, base: Column) -> Column:
    """Main (else first) camera's pixels, a bonus for stabilisation and for more rear cameras."""
    rear = F.size(F.filter(cameras, lambda c: F.coalesce(c["type"] != "selfie", F.lit(True))))
    return F.when(F.size(cameras) > 0, py_round(F.least(F.lit(100.0), base * 0.6 + F.least(rear, F.lit(4)) / 4 * 20 + F.when(main["ois"], 8.0).otherwise(0.0)), 1))


def battery_score(mah: Column, wired: Column, wireless: Column, cap: dict[str, Column]) -> Column:
    """Capacity, charging (0 W is none) and process efficiency."""
    plug = lambda c, n: F.when(c.isNotNull() & (c != 0), F.coalesce(cap[n], F.lit(0.0))).otherwise(0.0)
    total = cap["battery_mah"] * 0.45 + plug(wired, "charging_wired_w") * 0.20 + plug(wireless, "charging_wireless_w") * 0.10 + F.coalesce(cap["process_nm"], F.lit(50.0)) * 0.25
    return F.when(mah > 0, py_round(total, 1))


def display_score(display: Column, cap: dict[str, Column]) -> Column:
    part = lambda n: F.coalesce(cap[n], F.lit(50.0))
    any_ = display["refresh_hz"].isNotNull() | display["brightness_nits"].isNotNull() | display["ppi"].isNotNull()
    return F.when(any_, py_round(part("refresh_hz") * 0.35 + part("brightness_nits") * 0.35 + part("ppi") * 0.30, 1))


def phone_scores(phones: DataFrame, socs: DataFrame) -> DataFrame:
    """All axes of phones with a chip; phones without one in the catalog give no row.

    Capabilities, axes and what is drawn from these are columns of their own, one step after
    the other, so that no step is worked out more than once.
    """
    c = F.col
    chip = socs.select(c("id").alias("soc_id"), "geekbench_single", "geekbench_multi", "antutu_score", "process_nm")
    main = F.coalesce(F.get(F.filter("cameras", lambda x: x["type"] == "main"), F.lit(0)), F.get("cameras", F.lit(0)))
    raw = {n: c(n) for n in ("geekbench_single", "geekbench_multi", "antutu_score", "ram_gb", "battery_mah", "charging_wired_w", "charging_wireless_w", "process_nm", "msrp_usd")}
    raw |= {n: c("display")[n] for n in ("refresh_hz", "brightness_nits", "ppi")} | {"main_camera_mp": c("_main")["mp"]}
    df = phones.join(chip, "soc_id").withColumns({"era": era_band(c("release_date")), "_main": main})
    df = df.withColumns({f"_{n}": capability(x, PHONE_SCALES[n]) for n, x in raw.items()})
    cap = {n: c(f"_{n}") for n in raw}
    gate = c("geekbench_single").isNotNull() | c("geekbench_multi").isNotNull() | c("antutu_score").isNotNull()
    df = df.select(
        "id", "slug", "msrp_usd", "era", "_msrp_usd",
        F.when(gate, combine([(cap["geekbench_single"], 0.25), (cap["geekbench_multi"], 0.30), (cap["antutu_score"], 0.30), (cap["ram_gb"], 0.15)])).alias("performance"),
        camera_score(c("cameras"), c("_main"), cap["main_camera_mp"]).alias("camera"),
        battery_score(c("battery_mah"), c("charging_wired_w"), c("charging_wireless_w"), cap).alias("battery"),
        display_score(c("display"), cap).alias("display"),
    )
    df = df.withColumn("overall", combine([(c(n), 1.0) for n in ("performance", "camera", "battery", "display")]))
    value = F.when((c("msrp_usd") != 0), py_round(c("overall") * 0.5 + c("_msrp_usd") * 0.5, 1))
    return with_relative(df.withColumn("value", value).drop("_msrp_usd"), "performance").drop("msrp_usd")
