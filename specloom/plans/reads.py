"""Queries of lists, pages and details, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions.mathx import CPU_CHAINS, CPU_SCALES, CPU_WEIGHTS, GPU_CHAINS, GPU_SCALES, GPU_WEIGHTS, SOC_SCALES
from specloom.operators import reads, records, scoring
from specloom.plans.catalog import _phone_sql, _SOC_SQL, brands, cap, era, latest, mean, phones, query, rnd, socs, tier_of
from specloom.sources.tables import counting_rows, table

# Small tables of what the catalog's tables lack; both engines read this text.
LAPTOPS = "(VALUES (1, 'lap-a', 'lap-a', 'Lap A', 217, 1, 1, 1200, 'Core', 'Card', 16, DATE '2022-05-01'), (2, 'lap-b', 'lap-a', 'Lap B', 217, 2, NULL, NULL, 'Core', NULL, 8, DATE '2021-05-01'), (3, 'lap-c', NULL, 'Lap C', 204, NULL, 9, 900, NULL, 'Card', 8, NULL), (4, 'lap-d', NULL, 'Lap D', -7, 1, 1, 700, NULL, NULL, 4, NULL)) AS t(id, slug, base_model_slug, name, brand_id, cpu_id, gpu_id, msrp_usd, cpu_name, gpu_name, ram_gb, release_date)"
MONITORS = "(VALUES (1, 'mon-a', 'Mon A', 217, 27.0, '2560x1440', 165, 'IPS', 300, DATE '2021-01-01'), (2, 'mon-b', 'Mon B', 204, 34.0, NULL, NULL, 'VA', NULL, NULL), (3, 'mon-c', 'Mon C', 217, 24.0, '1920x1080', 60, 'IPS', 100, DATE '2019-01-01'), (4, 'mon-d', 'Mon D', NULL, 24.0, NULL, 60, 'TN', 90, NULL)) AS t(id, slug, name, brand_id, size_inch, resolution, refresh_hz, panel_type, msrp_usd, release_date)"
GAMES = "(VALUES (1, 'g-a', 'G A', 4.5, 90, DATE '2020-01-01'), (2, 'g-b', 'G B', NULL, NULL, NULL), (3, 'g-c', 'G C', 3.25, 71, DATE '2018-06-01')) AS t(id, slug, name, rating, metacritic, release_date)"
SOFTWARE = "(VALUES (1, 's-a', 'S A', DATE '2001-01-01'), (2, 's-b', 'S B', NULL)) AS t(id, slug, name, release_date)"
WEBSITES = "(VALUES (1, 'w-a', 'W A', 'https://a.example', DATE '1999-01-01'), (2, 'w-b', 'W B', NULL, NULL)) AS t(id, slug, name, homepage_url, launch_date)"
BENCHED_CPUS = "(VALUES (1, 'c1', DATE '2023-01-01', 2000.0, 30000.0, NULL, NULL, NULL, NULL), (2, 'c2', DATE '2022-01-01', NULL, NULL, 2500.0, 12000.0, NULL, NULL), (3, 'c3', DATE '2023-06-01', NULL, 25000.0, 2400.0, NULL, NULL, NULL), (4, 'c4', DATE '2005-01-01', NULL, NULL, NULL, NULL, 20.5, NULL), (5, 'c5', DATE '2005-06-01', NULL, NULL, NULL, NULL, 11.0, 120.0), (6, 'c6', NULL, 1500.0, 9000.0, NULL, NULL, NULL, NULL), (7, 'c7', DATE '2010-01-01', NULL, NULL, NULL, NULL, NULL, NULL)) AS t(id, slug, release_date, cinebench_r23_single, cinebench_r23_multi, geekbench_single, geekbench_multi, specint2006, superpi_1m_sec)"
BENCHED_GPUS = "(VALUES (1, 'g1', DATE '2020-09-17', 18000.0, NULL, 29.8, NULL), (2, 'g2', DATE '2021-01-01', NULL, 22000.0, 13.0, NULL), (3, 'g3', DATE '2020-01-01', NULL, NULL, 10.0, 900.0), (4, 'g4', DATE '2016-05-01', NULL, NULL, NULL, 120.0), (5, 'g5', NULL, 5000.0, NULL, NULL, NULL), (6, 'g6', DATE '2020-05-01', NULL, NULL, NULL, NULL)) AS t(id, slug, release_date, timespy_score, passmark_g3d_mark, fp32_tflops, blender_score)"


def inline(spark: SparkSession, values: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {values}")


def gpus(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return counting_rows(table(spark, d, "gpus"), "id", "updated_at", *cols)


def devices(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return counting_rows(table(spark, d, "mobile_devices"), "id", "updated_at", *cols)


# ---- Lists --------------------------------------------------------------------------


@query(f"SELECT slug, name, '/v1/brands/' || slug AS url FROM {latest('brands')} ORDER BY name NULLS FIRST, slug, id LIMIT 100")
def o01_default_order(spark, d):
    return reads.list_page(brands(spark, d), "brands", limit=100)


@query(f"(SELECT 'up' AS page, slug, name, '/v1/smartphones/' || slug AS url FROM {latest('smartphones')} ORDER BY release_date NULLS FIRST, slug, id LIMIT 30 OFFSET 10) UNION ALL (SELECT 'down', slug, name, '/v1/smartphones/' || slug FROM {latest('smartphones')} ORDER BY msrp_usd DESC NULLS LAST, slug, id LIMIT 50)")
def o02_allowed_sort(spark, d):
    p = phones(spark, d, "slug", "name", "release_date", "msrp_usd")
    up, down = reads.list_page(p, "smartphones", "release_date", 10, 30), reads.list_page(p, "smartphones", "-msrp_usd", 0, 50)
    return up.select(F.lit("up").alias("page"), "*").unionByName(down.select(F.lit("down").alias("page"), "*"))


_BY_BRAND = f"FROM {latest('smartphones')} p WHERE p.brand_id = (SELECT min(id) FROM {latest('brands')} WHERE slug = '{{slug}}')"


@query(" UNION ALL ".join(f"SELECT '{s}' AS brand, count(*) AS n {_BY_BRAND.format(slug=s)}" for s in ("korvano", "no-such-brand")))
def f02_unknown_slug(spark, d):
    """A slug that no brand has gives an empty list, not an error."""
    p, b = phones(spark, d, "brand_id"), {"brands": brands(spark, d)}
    known, unknown = (reads.count_of(reads.matching(p, "smartphones", b, brand=s)).select(F.lit(s).alias("brand"), F.col("count").alias("n")) for s in ("korvano", "no-such-brand"))
    return known.unionByName(unknown)


@query(f"SELECT count(*) AS total, count(*) FILTER (segment = 'laptop') AS laptops FROM {latest('cpus')}")
def a01_filtered_count(spark, d):
    c = counting_rows(table(spark, d, "cpus"), "id", "updated_at", "segment")
    one = reads.count_of(reads.matching(c, "cpus", {}, segment="laptop")).select(F.col("count").alias("laptops"))
    # Two tables of one row.
    return reads.count_of(c).select(F.col("count").alias("total"), F.lit(1).alias("k")).join(one.withColumn("k", F.lit(1)), "k").drop("k")


@query(f"SELECT slug, name, '/v1/smartphones/' || slug AS url {_BY_BRAND.format(slug='korvano')} ORDER BY name NULLS FIRST, slug, id LIMIT 20 OFFSET 20")
def f01_list_by_brand(spark, d):
    p = phones(spark, d, "slug", "name", "brand_id")
    return reads.list_page(reads.matching(p, "smartphones", {"brands": brands(spark, d)}, brand="korvano"), "smartphones", None, 20, 20)


@query(f"WITH s AS (SELECT slug FROM {latest('socs')} WHERE slug IS NOT NULL ORDER BY slug LIMIT 1) SELECT slug, name, '/v1/smartphones/' || slug AS url FROM {latest('smartphones')} WHERE soc_id = (SELECT min(id) FROM {latest('socs')} WHERE slug = (SELECT slug FROM s)) ORDER BY name NULLS FIRST, slug, id LIMIT 100")
def j07_soc_phones(spark, d):
    """The phones of the first chip by slug."""
    s = socs(spark, d)
    first = s.where("slug is not null").agg(F.min("slug").alias("slug"))
    chosen = s.join(F.broadcast(first), "slug").agg(F.min("id").alias("_id"))  # one row
    p = phones(spark, d, "slug", "name", "soc_id")
    return reads.list_page(p.join(F.broadcast(chosen), F.col("soc_id") == F.col("_id"), "left_semi"), "smartphones", limit=100)


@query(f"SELECT slug, name, '/v1/brands/' || slug AS url FROM {latest('brands')}")
def s33_all_pages(spark, d):
    """A list taken page by page is the whole list (a fixed table of some 150 brands)."""
    rows = [tuple(r) for page in reads.all_pages(brands(spark, d), "brands", 50) for r in page]
    return spark.createDataFrame(rows, "slug string, name string, url string")


@query("SELECT category, count(*) AS n FROM mobile_devices GROUP BY 1 UNION ALL SELECT 'brand', count(*) FROM brands UNION ALL SELECT 'soc', count(*) FROM socs")
def a02_category_counts(spark, d):
    """Rows per category, as they are loaded."""
    by = table(spark, d, "mobile_devices").groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    whole = [reads.count_of(table(spark, d, t)).select(F.lit(c).alias("category"), F.col("count").alias("n")) for c, t in (("brand", "brands"), ("soc", "socs"))]
    return by.unionByName(whole[0]).unionByName(whole[1])


@query(f"SELECT slug, min(id) AS id FROM {latest('brands')} WHERE slug IS NOT NULL GROUP BY 1")
def j06_slug_to_id(spark, d):
    return brands(spark, d).where("slug is not null").groupBy("slug").agg(F.min("id").alias("id"))


@query(f"SELECT id, slug, name, country FROM {latest('brands')} WHERE slug = 'korvano' ORDER BY id LIMIT 1")
def f07_lookup(spark, d):
    return reads.lookup(brands(spark, d), "korvano").select("id", "slug", "name", "country")


@query("SELECT count(*) AS count, CASE WHEN 20 < count(*) THEN '/v1/cpus?segment=hedt&offset=20' END AS next, NULL::VARCHAR AS previous FROM " + latest("cpus") + " WHERE segment = 'hedt'")
def o04_envelope(spark, d):
    c = reads.matching(counting_rows(table(spark, d, "cpus"), "id", "updated_at", "segment"), "cpus", {}, segment="hedt")
    count = reads.count_of(c).first()["count"]
    return spark.createDataFrame([tuple(records.page_links(count, "/v1/cpus", {"segment": "hedt"}).values())], "count bigint, next string, previous string")


@query(f"SELECT slug, name, '/v1/socs/' || slug AS url FROM {latest('socs')}")
def p01_refs(spark, d):
    return socs(spark, d).select("slug", "name", reads.url("socs", "slug").alias("url"))


@query(f"SELECT slug, name, '/v1/laptops/' || slug AS url FROM {LAPTOPS} WHERE base_model_slug = 'lap-a' AND brand_id = 217 ORDER BY msrp_usd NULLS FIRST, slug, id LIMIT 20")
def o02_laptop_list(spark, d):
    return reads.list_page(reads.matching(inline(spark, LAPTOPS).where("brand_id = 217"), "laptops", {}, base_model_slug="lap-a"), "laptops", "msrp_usd")


@query(f"SELECT slug, name, '/v1/monitors/' || slug AS url FROM {MONITORS} WHERE panel_type = 'IPS' ORDER BY size_inch DESC NULLS LAST, slug, id LIMIT 20")
def o02_monitor_list(spark, d):
    return reads.list_page(reads.matching(inline(spark, MONITORS), "monitors", {}, panel_type="IPS"), "monitors", "-size_inch")


# ---- Details ------------------------------------------------------------------------

_B = lambda on, p: f"{p}.slug AS {on}_slug, {p}.name AS {on}_name, '/v1/brands/' || {p}.slug AS {on}_url"
_SOC_REF = "s.slug AS soc_slug, s.name AS soc_name, '/v1/socs/' || s.slug AS soc_url, m.slug AS soc_manufacturer_slug, m.name AS soc_manufacturer_name, '/v1/brands/' || m.slug AS soc_manufacturer_url"


def _parents(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {"brands": brands(spark, d), "socs": socs(spark, d), "cpus": counting_rows(table(spark, d, "cpus"), "id", "updated_at", "slug", "name"), "gpus": gpus(spark, d, "slug", "name")}


@query(f"SELECT s.id, s.slug, s.name, s.release_date, s.process_nm, s.cpu_config, s.gpu_name, {_B('manufacturer', 'b')}, '/v1/socs/' || s.slug AS url FROM {latest('socs')} s JOIN {latest('brands')} b ON s.manufacturer_id = b.id")
def p02_soc_detail(spark, d):
    s = counting_rows(table(spark, d, "socs"), "id", "updated_at", "slug", "name", "manufacturer_id", "release_date", "process_nm", "cpu_config", "gpu_name")
    return reads.detail(s, "socs", _parents(spark, d))


@query(f"SELECT g.id, g.slug, g.name, g.architecture, g.release_date, g.memory_gb, g.memory_type, g.memory_bus_bit, g.base_clock_mhz, g.boost_clock_mhz, g.tdp_w, g.pcie_version, {_B('manufacturer', 'b')}, '/v1/gpus/' || g.slug AS url FROM {latest('gpus')} g JOIN {latest('brands')} b ON g.manufacturer_id = b.id")
def p02_gpu_detail(spark, d):
    return reads.detail(gpus(spark, d), "gpus", _parents(spark, d))


_CPU_COLUMNS = "release_date, segment, architecture, socket, cores, threads, base_clock_ghz, boost_clock_ghz, l3_cache_mb, tdp_w, msrp_usd, verified"


@query(f"SELECT id, slug, name, {_CPU_COLUMNS}, b.manufacturer_slug, b.manufacturer_name, '/v1/brands/' || b.manufacturer_slug AS manufacturer_url, '/v1/cpus/' || slug AS url FROM (SELECT *, lower(trim(manufacturer.slug)) AS k FROM {latest('cpus')}) c JOIN (SELECT slug AS manufacturer_slug, arg_min(name, id) AS manufacturer_name FROM {latest('brands')} GROUP BY 1) b ON c.k = b.manufacturer_slug")
def p02_cpu_detail(spark, d):
    """Processors refer to their maker by slug: the slug's first brand stands for it."""
    first = brands(spark, d).groupBy("slug").agg(F.min_by("name", "id").alias("name")).withColumn("id", F.col("slug"))
    c = counting_rows(table(spark, d, "cpus")).withColumn("manufacturer_id", F.lower(F.trim("manufacturer.slug"))).drop("manufacturer")
    return reads.detail(c, "cpus", {"brands": first})


_PHONE_COLUMNS = "base_model_slug, release_date, msrp_usd, ram_gb, battery_mah, charging_wired_w, charging_wireless_w, weight_g, os, verified"


@query(f"SELECT p.id, p.slug, p.name, {', '.join('p.' + c for c in _PHONE_COLUMNS.split(', '))}, {_B('brand', 'b')}, b.country AS brand_country, {_SOC_REF}, '/v1/smartphones/' || p.slug AS url FROM {latest('smartphones')} p JOIN {latest('brands')} b ON p.brand_id = b.id JOIN {latest('socs')} s ON p.soc_id = s.id JOIN {latest('brands')} m ON s.manufacturer_id = m.id")
def p02_phone_detail(spark, d):
    return reads.detail(phones(spark, d, "slug", "name", "brand_id", "soc_id", *_PHONE_COLUMNS.split(", ")), "smartphones", _parents(spark, d))


@query(f"SELECT p.id, p.slug, p.name, p.base_model_slug, p.release_date, p.msrp_usd, p.ram_gb, p.battery_mah, p.weight_g, p.os, {_B('brand', 'b')}, b.country AS brand_country, {_SOC_REF}, '/v1/tablets/' || p.slug AS url FROM {latest('mobile_devices')} p JOIN {latest('brands')} b ON p.brand_id = b.id LEFT JOIN ({latest('socs')} s JOIN {latest('brands')} m ON s.manufacturer_id = m.id) ON p.soc_id = s.id WHERE p.category = 'tablet'")
def p02_tablet_detail(spark, d):
    t = devices(spark, d, "category", "slug", "name", "base_model_slug", "brand_id", "soc_id", "release_date", "msrp_usd", "ram_gb", "battery_mah", "weight_g", "os")
    return reads.detail(t.where("category = 'tablet'"), "tablets", _parents(spark, d))


@query(
    f"SELECT l.id, l.slug, l.name, l.base_model_slug, l.release_date, l.msrp_usd, l.cpu_name, l.gpu_name, l.ram_gb, {_B('brand', 'b')}, b.country AS brand_country, c.slug AS cpu_slug, c.name AS cpu_part_name, '/v1/cpus/' || c.slug AS cpu_url, g.slug AS gpu_slug, g.name AS gpu_part_name, '/v1/gpus/' || g.slug AS gpu_url, '/v1/laptops/' || l.slug AS url "
    f"FROM {LAPTOPS.replace('AS t(', 'AS l(')} JOIN {latest('brands')} b ON l.brand_id = b.id LEFT JOIN {latest('cpus')} c ON l.cpu_id = c.id LEFT JOIN {latest('gpus')} g ON l.gpu_id = g.id"
)
def j04_laptop_detail(spark, d):
    return reads.detail(inline(spark, LAPTOPS), "laptops", _parents(spark, d))


@query(f"SELECT l.id, l.slug, l.name, l.release_date, l.msrp_usd, l.size_inch::DOUBLE AS size_inch, l.resolution, l.refresh_hz, l.panel_type, {_B('brand', 'b')}, b.country AS brand_country, '/v1/monitors/' || l.slug AS url FROM {MONITORS.replace('AS t(', 'AS l(')} JOIN {latest('brands')} b ON l.brand_id = b.id")
def j05_monitor_detail(spark, d):
    return reads.detail(inline(spark, MONITORS).withColumn("size_inch", F.col("size_inch").cast("double")), "monitors", _parents(spark, d))


@query(f"SELECT id, slug, name, release_date, rating::DOUBLE AS rating, metacritic, '/v1/games/' || slug AS url FROM {GAMES}")
def p02_game_detail(spark, d):
    return reads.detail(inline(spark, GAMES).withColumn("rating", F.col("rating").cast("double")), "games", {})


@query(f"SELECT id, slug, name, release_date, '/v1/software/' || slug AS url FROM {SOFTWARE}")
def p02_software_detail(spark, d):
    return reads.detail(inline(spark, SOFTWARE), "software", {})


@query(f"SELECT id, slug, name, homepage_url, launch_date, '/v1/websites/' || slug AS url FROM {WEBSITES}")
def p02_website_detail(spark, d):
    return reads.detail(inline(spark, WEBSITES), "websites", {})


@query(f"SELECT id, slug, name, country, founded_year, '/v1/brands/' || slug AS url FROM {latest('brands')}")
def p02_brand_detail(spark, d):
    return reads.detail(brands(spark, d).drop("source_urls"), "brands", {})


# ---- Scores by chains and cohorts ---------------------------------------------------


def _chain_sql(values: str, chains: dict, scales: dict, weights: dict, columns: set[str]) -> str:
    caps = {n: cap(n, scales[n]) for chain in chains.values() for n in chain if n in columns}
    axes = ", ".join(
        f"coalesce({', '.join(f'({caps[n]})' for n in chain if n in columns)}) AS {dim}_index, CASE " + " ".join(f"WHEN ({caps[n]}) IS NOT NULL THEN '{n}'" for n in chain if n in columns) + f" END AS {dim}_source"
        for dim, chain in chains.items()
    )
    cte = f"SELECT *, {mean([(f'{dim}_index', weights[dim]) for dim in chains])} AS overall FROM (SELECT id, slug, {era('release_date')} AS era, {axes} FROM {values})"
    for dim in chains:
        pct = rnd(f"100.0::DOUBLE * (SELECT count(*) FROM c x WHERE x.era = c.era AND x.{dim}_index <= c.{dim}_index) / (SELECT count(*) FROM c x WHERE x.era = c.era AND x.{dim}_index IS NOT NULL)")
        inside = f"CASE WHEN era IS NOT NULL AND {dim}_index IS NOT NULL THEN"
        cte = f"WITH c AS ({cte}) SELECT *, {tier_of(f'{dim}_percentile')} AS {dim}_tier, {inside} (SELECT count(*) FROM c x WHERE x.era = c.era AND x.{dim}_index IS NOT NULL) END AS {dim}_cohort FROM (SELECT *, {inside} {pct} END AS {dim}_percentile FROM c) c"
    return cte


_CPU_HAS = {"cinebench_r23_single", "cinebench_r23_multi", "geekbench_single", "geekbench_multi", "specint2006", "superpi_1m_sec"}
_GPU_HAS = {"timespy_score", "passmark_g3d_mark", "fp32_tflops", "blender_score"}


@query(_chain_sql(BENCHED_CPUS, CPU_CHAINS, CPU_SCALES, CPU_WEIGHTS, _CPU_HAS))
def q01_cpu_scores(spark, d):
    return scoring.chain_scores(inline(spark, BENCHED_CPUS), CPU_CHAINS, CPU_SCALES, CPU_WEIGHTS)


@query(_chain_sql(BENCHED_GPUS, GPU_CHAINS, GPU_SCALES, GPU_WEIGHTS, _GPU_HAS))
def q02_gpu_scores(spark, d):
    return scoring.chain_scores(inline(spark, BENCHED_GPUS), GPU_CHAINS, GPU_SCALES, GPU_WEIGHTS)


_DIMENSIONS = {
    "cpu.single": (_chain_sql(BENCHED_CPUS, CPU_CHAINS, CPU_SCALES, CPU_WEIGHTS, _CPU_HAS), "single_index"),
    "cpu.multi": (_chain_sql(BENCHED_CPUS, CPU_CHAINS, CPU_SCALES, CPU_WEIGHTS, _CPU_HAS), "multi_index"),
    "gpu.graphics": (_chain_sql(BENCHED_GPUS, GPU_CHAINS, GPU_SCALES, GPU_WEIGHTS, _GPU_HAS), "graphics_index"),
    "soc.cpu": (_SOC_SQL, "cpu_index"),
    "soc.system": (_SOC_SQL, "system_index"),
    "phone.perf": (_phone_sql(), "performance"),
}


@query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS dimension, era, count(*) AS cohort, max(v) AS best, min(v) FILTER (p >= 50) AS middle FROM (SELECT era, v, {rnd('100.0::DOUBLE * cume_dist() OVER (PARTITION BY era ORDER BY v)')} AS p FROM (SELECT era, {v} AS v FROM ({sql})) WHERE era IS NOT NULL AND v IS NOT NULL) GROUP BY era"
        for n, (sql, v) in _DIMENSIONS.items()
    )
)
def q10_cohort_stats(spark, d):
    cpu, gpu, soc = q01_cpu_scores(spark, d), q02_gpu_scores(spark, d), scoring.soc_scores(socs(spark, d))
    p = phones(spark, d, "slug", "soc_id", "msrp_usd", "ram_gb", "release_date", "display", "cameras", "battery_mah", "charging_wired_w", "charging_wireless_w")
    rows = {"cpu.single": cpu, "cpu.multi": cpu, "gpu.graphics": gpu, "soc.cpu": soc, "soc.system": soc, "phone.perf": scoring.phone_scores(p, socs(spark, d))}
    return scoring.cohort_stats({n: (rows[n], v) for n, (_, v) in _DIMENSIONS.items()})


@query(" UNION ALL ".join(f"SELECT 'soc.{n}' AS benchmark, count({n}) AS n, (list_sort(list({n})))[round_even(0.01::DOUBLE * (count({n}) - 1), 0)::INT + 1]::DOUBLE AS lo, (list_sort(list({n})))[round_even(0.99::DOUBLE * (count({n}) - 1), 0)::INT + 1]::DOUBLE AS hi FROM {latest('socs')} WHERE {n} IS NOT NULL HAVING count({n}) >= 5" for n in SOC_SCALES))
def q11_calibration(spark, d):
    """Bounds of every benchmark with five values or more; the small tables have fewer."""
    long = None
    for category, rows, names in (("cpu", inline(spark, BENCHED_CPUS), sorted(_CPU_HAS)), ("gpu", inline(spark, BENCHED_GPUS), sorted(_GPU_HAS)), ("soc", socs(spark, d), list(SOC_SCALES))):
        one = rows.select(*[F.col(n).cast("double").alias(n) for n in names]).unpivot([], names, "benchmark", "v").where("v is not null")
        one = one.withColumn("benchmark", F.concat(F.lit(f"{category}."), "benchmark"))
        long = one if long is None else long.unionByName(one)
    return records.rank_bounds(long, ["benchmark"], "v")
