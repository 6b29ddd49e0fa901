"""Verification: trust of sources, cross references, freshness and promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.functions.mathx import py_round
from specloom.functions.parsers import host_of, resolution
from specloom.functions.text import normalize_heading

# Hosts by tier of trust.
TIER_HOSTS = {
    1: ("ark.intel.com", "intel.com", "amd.com", "qualcomm.com", "apple.com", "nvidia.com", "samsung.com", "mediatek.com", "arm.com", "en.wikipedia.org", "wikipedia.org", "wikichip.org", "en.wikichip.org", "techpowerup.com"),
    2: ("gsmarena.com", "phonedb.net", "cpubenchmark.net", "videocardbenchmark.net", "nanoreview.net", "technical.city", "topcpu.net", "notebookcheck.net", "geekbench.com", "kimovil.com", "devicespecifications.com"),
    3: ("kaggle.com", "github.com", "raw.githubusercontent.com", "commons.wikimedia.org", "jsdelivr.net", "cdn.jsdelivr.net", "aitoolbuzz.com"),
}

# The first year of a major version of Android.
ANDROID_YEARS = {4: 2011, 5: 2014, 6: 2015, 7: 2016, 8: 2017, 9: 2018, 10: 2019, 11: 2020, 12: 2021, 13: 2022, 14: 2023, 15: 2024, 16: 2025}


def host_tier(host: Column) -> Column:
    """The tier of a host or of the host it is below; 0 for others."""
    out = None
    for tier, hosts in TIER_HOSTS.items():
        hit = host.rlike(r"(^|\.)(" + "|".join(h.replace(".", r"\.") for h in hosts) + ")$")
        out = F.when(hit, tier) if out is None else out.when(hit, tier)
    return out.otherwise(0)


def best_tier(urls: Column) -> Column:
    """The least tier over addresses; 0 without a known one."""
    return F.coalesce(F.array_min(F.filter(F.transform(urls, lambda u: host_tier(host_of(u))), lambda t: t > 0)), F.lit(0))


def strong_hosts(urls: Column) -> Column:
    hosts = F.array_distinct(F.transform(urls, host_of))
    return F.size(F.filter(hosts, lambda h: host_tier(h).isin(1, 2)))


def host_score(urls: Column) -> Column:
    """26, 18, 6 or 3 by the best tier, 4 more for two strong hosts, at most 30."""
    best = best_tier(urls)
    base = F.when(best == 1, 26.0).when(best == 2, 18.0).when(best == 3, 6.0).otherwise(3.0)
    return F.least(base + F.when(strong_hosts(urls) >= 2, 4.0).otherwise(0.0), F.lit(30.0))


def has_key_like(raw: Column, prefix: str) -> Column:
    """Whether a JSON object has a key that begins with ``prefix``; false for what is no object."""
    return F.coalesce(F.exists(F.json_object_keys(raw), lambda k: k.startswith(prefix)), F.lit(False))


def provenance(raw: Column, tier: Column) -> Column:
    """7 points without raw parts; with them 5, and 3 more or less by a source of tier 1 or 2."""
    return F.when(~raw, 7.0).when(tier.isin(1, 2), 8.0).otherwise(2.0)


def phone_signals(now_year: int) -> list[tuple[Column, bool]]:
    """(signal, hard) of phones with their chip's release date ``soc_date``: true, false, or null where not applicable."""
    c, year = F.col, F.year("release_date")
    r, size, ppi, storage = resolution(c("display.resolution")), c("display.size_inch"), c("display.ppi"), c("storage_options_gb")
    dense = F.sqrt(r["w"].cast("double") ** 2 + r["h"].cast("double") ** 2) / F.nullif(size, F.lit(0.0))
    sane = ~F.exists(storage, lambda x: x.isNull()) & (F.array_min(storage) >= 1) & (storage == F.array_sort(F.array_distinct(storage)))
    major = F.regexp_extract(F.lower("os"), r"android\s*(\d{1,2})", 1)
    least = F.lit(None).cast("int")
    for version, first in ANDROID_YEARS.items():
        least = F.when(major.isin(str(version), f"0{version}"), first).otherwise(least)
    slack = F.when(F.date_format("soc_date", "MM-dd") == "01-01", 2).otherwise(0)
    return [
        (F.when(size > 0, F.abs(dense - ppi) <= 0.15 * ppi), False),
        (F.when(F.size(storage) > 0, F.coalesce(sane, F.lit(False))), False),
        (year >= least, False),
        (year <= now_year + 1, True),
        (c("ram_gb") <= F.array_max(storage), False),
        (F.year("soc_date") <= year + slack, False),
    ]


def cpu_signals(now_year: int) -> dict[str, tuple[Column, bool]]:
    """name -> (signal, hard) of processors; a comparison with an unknown side is null."""
    c = F.col
    return {
        "threads_ge_cores": (c("threads") >= c("cores"), True),
        "boost_ge_base": (c("boost_clock_ghz") >= c("base_clock_ghz"), True),
        "max_tdp_ge_tdp": (c("max_tdp_w") >= c("tdp_w"), False),
        "cb23_multi_ge_single": (c("cinebench_r23_multi") >= c("cinebench_r23_single"), False),
        "gb_multi_ge_single": (c("geekbench_multi") >= c("geekbench_single"), False),
        "release_not_future": (F.year("release_date") <= now_year + 1, True),
        "hybrid_core_sum": (c("p_cores") + c("e_cores") == c("cores"), False),
    }


def gpu_signals(now_year: int) -> dict[str, tuple[Column, bool]]:
    """As cpu_signals, of graphics cards; ``manufacturer`` is a slug."""
    c, maker = F.col, F.lower("manufacturer")
    filed = lambda own, foreign: F.when(c(own).isNotNull(), True).when(c(foreign).isNotNull(), False)
    return {
        "boost_ge_base": (c("boost_clock_mhz") >= c("base_clock_mhz"), True),
        "release_not_future": (F.year("release_date") <= now_year + 1, True),
        "vendor_core_field": (F.when(maker == "nvidia", filed("cuda_cores", "stream_processors")).when(maker.isin("amd", "intel"), filed("stream_processors", "cuda_cores")).when(c("cuda_cores").isNotNull() | c("stream_processors").isNotNull(), True), False),
        "rt_cores_era": (F.when(c("rt_cores") > 0, F.year("release_date") >= 2018), False),
    }


def soc_signals(now_year: int) -> dict[str, tuple[Column, bool]]:
    """As cpu_signals, of chips."""
    year, nm = F.year("release_date"), F.col("process_nm")
    return {
        "release_not_future": (year <= now_year + 1, True),
        "process_nm_era": (~(((nm < 7) & (year < 2017)) | ((nm < 3) & (year < 2022))), False),
        "gpu_name_present": (F.coalesce(F.trim("gpu_name") != "", F.lit(False)), False),
    }


#: Columns that each signal reads, for rows that lack some of them.
_READS = {
    "threads_ge_cores": ("threads", "cores"), "boost_ge_base": (), "max_tdp_ge_tdp": ("max_tdp_w", "tdp_w"), "cb23_multi_ge_single": ("cinebench_r23_multi", "cinebench_r23_single"), "gb_multi_ge_single": ("geekbench_multi", "geekbench_single"),
    "hybrid_core_sum": ("p_cores", "e_cores", "cores"), "vendor_core_field": ("manufacturer", "cuda_cores", "stream_processors"), "rt_cores_era": ("rt_cores",), "release_not_future": ("release_date",),
}


def long_signals(rows: DataFrame, signals: dict[str, tuple[Column, bool]], key: str) -> DataFrame:
    """(key, signal, result): pass, fail or na per row and signal whose columns the rows have."""
    there = set(rows.columns)

    def asked(name: str) -> bool:
        if name == "boost_ge_base":
            return bool({"boost_clock_ghz", "boost_clock_mhz"} & there)
        return set(_READS.get(name, ())) <= there

    result = lambda ok: F.when(ok.isNull(), "na").when(ok, "pass").otherwise("fail")
    cells = F.array(*[F.struct(F.lit(n).alias("signal"), result(ok).alias("result")) for n, (ok, _) in signals.items() if asked(n)])
    return rows.select(key, F.explode(cells).alias("s")).select(key, "s.signal", "s.result")


def tier0(rich: list[Column], signals: list[tuple[Column, bool]], urls: Column, raw: Column | None = None) -> Column:
    """Struct (band, total, best_tier) of the offline plausibility score.

    Rich fields present give up to 25 points, passed signals among those that apply up to 35
    (all where none applies), hosts up to 30, provenance up to 10 (``raw``: whether a record
    holds raw parts; none do by default). A failed hard
    signal is red whatever the score; green takes 75 points and a source of tier 1 or 2.
    """
    count = lambda flags: sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0))
    asked, passed, failed = count(s.isNotNull() for s, _ in signals), count(s for s, _ in signals), count(~s for s, hard in signals if hard)
    best = best_tier(urls)
    total = 25.0 * count(rich) / float(len(rich)) + F.when(asked == 0, 35.0).otherwise(35.0 * passed / F.greatest(asked, F.lit(1))) + host_score(urls) + provenance(F.lit(False) if raw is None else raw, best)
    band = F.when(failed > 0, "red").when((total >= 75) & best.isin(1, 2), "green").when(total < 45, "red").otherwise("yellow")
    return F.struct(band.alias("band"), py_round(total).alias("total"), best.alias("best_tier"))


def failed(signals: list[tuple[Column, bool]], names: list[str]) -> Column:
    """The names of the hard signals that failed, marked with "!"; ``names`` are those of the hard ones in order."""
    hard = [s for s, is_hard in signals if is_hard]
    return F.array_compact(F.array(*[F.when(~s, f"!{n}") for s, n in zip(hard, names, strict=True)])) if hard else F.array().cast("array<string>")


def fresh(checked: Column, now: Column, days: int) -> Column:
    """Whether fewer than ``days`` whole days have gone by; false without a time."""
    return F.coalesce(F.floor((F.unix_timestamp(now) - F.unix_timestamp(checked)) / 86400) < days, F.lit(False))


def crossref(records: DataFrame, candidates: DataFrame, key: str = "record_id") -> DataFrame:
    """(key, decision) from the candidates found for each record (key, rank, title, year).

    Headings agree when equal, or when the candidate's has four letters and one ends the
    other; empty ones never. The best agreeing candidate has a year and the least rank; a
    year within one confirms, another contradicts, none is ambiguous, and so are candidates
    none of which agrees. A record without a name or candidates is notfound. ``records``
    have key, name and year.
    """
    c = candidates.select(key, F.col("rank").alias("_rank"), normalize_heading(F.col("title")).alias("_h"), F.col("year").alias("_found"))
    r = records.select(key, normalize_heading(F.col("name")).alias("_n"), F.col("year").alias("_own"), (F.trim("name") != "").alias("_named"))
    near = (F.col("_h") != "") & (F.col("_n") != "") & ((F.col("_h") == F.col("_n")) | ((F.length("_h") >= 4) & (F.col("_n").endswith(F.col("_h")) | F.col("_h").endswith(F.col("_n")))))
    of = r.where("_named").select(key, "_n").join(c, key)
    best = of.groupBy(key).agg(F.min_by(F.when(near, F.struct("_found")), F.when(near, F.struct(F.col("_found").isNull(), "_rank"))).alias("_best"), F.count_if(near).alias("_agree"))
    gap = F.abs(F.col("_own") - F.col("_best._found"))
    decision = F.when(F.col("_agree").isNull(), "notfound").when((F.col("_agree") == 0) | gap.isNull(), "ambiguous").when(gap <= 1, "confirm").otherwise("contradict")
    return r.join(best, key, "left").select(key, decision.alias("decision"))


def found_headings(records: DataFrame, entries: DataFrame, key: str = "record_id") -> DataFrame:
    """(key, rank, title, year): for each record the entries whose headings agree with its name, as ``crossref`` reads them.

    ``entries`` have title, rank and year. Each heading is searched once, by its endings;
    of entries with one heading the one that ``crossref`` would prefer stands for all.
    """
    e = entries.select(normalize_heading(F.col("title")).alias("h"), "rank", "year").where("h <> ''")
    e = e.groupBy("h").agg(F.min(F.struct(F.col("year").isNull().alias("blank"), "rank", "year")).alias("e")).select("h", "e.rank", "e.year")
    r = records.select(key, normalize_heading(F.col("name")).alias("n")).where("n <> ''")
    # The endings of ``c`` of at least ``least`` letters, and ``c`` itself.
    endings = lambda c, least: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - least + 1, F.lit(1))), lambda i: F.substr(c, i))
    names = r.select("n").distinct()
    within = names.withColumn("h", F.explode(endings(F.col("n"), 4))).join(e.select("h"), "h")
    around = e.select("h").where("length(h) >= 4").withColumn("n", F.explode(endings(F.col("h"), 1))).join(names, "n")
    pairs = within.select("n", "h").union(around.select("n", "h")).distinct()
    return r.join(pairs, "n").join(e, "h").select(key, "rank", F.col("h").alias("title"), "year")


def promotion(band: Column, decision: Column) -> Column:
    """Struct (promote, reason): a contradiction vetoes, a confirmation or a green band promotes."""
    pair = lambda yes, why: F.struct(F.lit(yes).alias("promote"), F.lit(why).alias("reason"))
    return F.when(decision == "contradict", pair(False, "crossref-contradict")).when(decision == "confirm", pair(True, "crossref-confirm")).when(band == "green", pair(True, "green")).otherwise(pair(False, "needs-confirmation"))
