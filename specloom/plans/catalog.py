"""Catalog queries with their SQL: scores, listings, validation, joins, parsers, aggregates."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions import mathx, parsers, text
from specloom.functions.mathx import ERA_BANDS, PHONE_SCALES, SOC_SCALES, TIERS, Scale, capability, combine, era_band, py_round
from specloom.operators import records, scoring, verify
from specloom.session import cut
from specloom.sources.tables import counting_rows, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


# ---- SQL pieces ---------------------------------------------------------------------


def latest(name: str, cols: str = "*") -> str:
    return f"(SELECT {cols} FROM {name} QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1)"


def rnd(x: str, n: int = 1) -> str:
    return f"printf('%.{n}f', {x})::DOUBLE"


def cap(x: str, s: Scale) -> str:
    c = f"least(greatest(({x})::DOUBLE, {float(s.lo)}::DOUBLE), {float(s.hi)}::DOUBLE)"
    ratio = f"(ln({c}) - {math.log(s.lo)!r}::DOUBLE) / {math.log(s.hi) - math.log(s.lo)!r}::DOUBLE" if s.log else f"({c} - {float(s.lo)}::DOUBLE) / {float(s.hi - s.lo)}::DOUBLE"
    if s.invert:
        ratio = f"1.0::DOUBLE - {ratio}"
    return f"CASE WHEN ({x}) IS NOT NULL THEN {rnd(f'least(greatest(({ratio}) * 100.0::DOUBLE, 0.0::DOUBLE), 100.0::DOUBLE)')} END"


def mean(parts: list[tuple[str, float]]) -> str:
    top = " + ".join(f"coalesce({v} * {w}::DOUBLE, 0.0::DOUBLE)" for v, w in parts)
    weight = " + ".join(f"CASE WHEN {v} IS NOT NULL THEN {w}::DOUBLE ELSE 0.0::DOUBLE END" for v, w in parts)
    return f"CASE WHEN ({weight}) > 0 THEN {rnd(f'({top}) / ({weight})')} END"


def era(x: str) -> str:
    return "CASE " + " ".join(f"WHEN year({x}) BETWEEN {a} AND {b} THEN '{n}'" for a, b, n in ERA_BANDS) + " END"


def tier_of(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} >= {t} THEN '{n}'" for t, n in TIERS) + " END"


def _relative(cte: str, index: str, cols: str) -> str:
    part = f"PARTITION BY era, ({index} IS NOT NULL AND era IS NOT NULL)"
    inside = f"CASE WHEN {index} IS NOT NULL AND era IS NOT NULL THEN"
    pct = f"{inside} {rnd(f'100.0::DOUBLE * cume_dist() OVER ({part} ORDER BY {index})')} END"
    return f"SELECT *, {tier_of('percentile')} AS tier FROM (SELECT {cols}, {pct} AS percentile, {inside} count(*) OVER ({part}) END AS cohort FROM ({cte}))"


def socs(spark: SparkSession, d: str) -> DataFrame:
    return counting_rows(table(spark, d, "socs"), "id", "updated_at", "slug", "name", "manufacturer_id", "release_date", "process_nm", "gpu_name", "geekbench_single", "geekbench_multi", "antutu_score", "deleted_at")


def brands(spark: SparkSession, d: str) -> DataFrame:
    return counting_rows(table(spark, d, "brands"))


def phones(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return counting_rows(table(spark, d, "smartphones"), "id", "updated_at", *cols)


def cpus(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return counting_rows(table(spark, d, "cpus"), "id", "updated_at", *cols)


# ---- Scores -------------------------------------------------------------------------

_ORDER_SCALE = Scale(5000, 450000)


@query(f"SELECT o_orderkey, {cap('o_totalprice', _ORDER_SCALE)} AS idx FROM orders")
def m01_capability_log(spark, d):
    return table(spark, d, "orders").select("o_orderkey", capability(F.col("o_totalprice"), _ORDER_SCALE).alias("idx"))


@query(f"SELECT id, {cap('battery_mah', PHONE_SCALES['battery_mah'])} AS linear, {cap('msrp_usd', PHONE_SCALES['msrp_usd'])} AS inverted FROM {latest('smartphones')}")
def m01_capability_linear(spark, d):
    return phones(spark, d, "battery_mah", "msrp_usd").select("id", capability(F.col("battery_mah"), PHONE_SCALES["battery_mah"]).alias("linear"), capability(F.col("msrp_usd"), PHONE_SCALES["msrp_usd"]).alias("inverted"))


@query(f"SELECT id, {mean([('geekbench_single', 0.25), ('geekbench_multi', 0.30), ('antutu_score', 0.45)])} AS mean FROM {latest('socs')}")
def m02_combine_renorm(spark, d):
    return socs(spark, d).select("id", combine([(F.col("geekbench_single").cast("double"), 0.25), (F.col("geekbench_multi").cast("double"), 0.30), (F.col("antutu_score").cast("double"), 0.45)]).alias("mean"))


@query(f"SELECT {era('release_date')} AS era, count(*) AS n FROM {latest('smartphones')} GROUP BY 1")
def m03_era_band(spark, d):
    return phones(spark, d, "release_date").groupBy(era_band(F.col("release_date")).alias("era")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"SELECT id, coalesce({cap('geekbench_multi', SOC_SCALES['geekbench_multi'])}, {cap('antutu_score', SOC_SCALES['antutu_score'])}) AS idx, "
    f"CASE WHEN geekbench_multi IS NOT NULL THEN 'geekbench_multi' WHEN antutu_score IS NOT NULL THEN 'antutu_score' END AS src FROM {latest('socs')}"
)
def m05_axis_chain(spark, d):
    a = mathx.axis([(F.col(n), SOC_SCALES[n], n) for n in ("geekbench_multi", "antutu_score")])
    return socs(spark, d).withColumn("a", a).select("id", F.col("a.index").alias("idx"), F.col("a.source").alias("src"))


_ORDER_ERAS = ((1995, 1996, "1995-96"), (1997, 1998, "1997-98"), (1999, 2001, "1999-2001"))


@query(
    _relative("SELECT o_orderkey, CASE WHEN year(o_orderdate) BETWEEN 1995 AND 1996 THEN '1995-96' WHEN year(o_orderdate) BETWEEN 1997 AND 1998 THEN '1997-98' WHEN year(o_orderdate) BETWEEN 1999 AND 2001 THEN '1999-2001' END AS era, " + cap("o_totalprice", _ORDER_SCALE) + " AS idx FROM orders", "idx", "o_orderkey, era, idx")
)
def w01_era_percentile(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", era_band(F.col("o_orderdate"), _ORDER_ERAS).alias("era"), capability(F.col("o_totalprice"), _ORDER_SCALE).alias("idx"))
    return scoring.with_relative(o, "idx")


_SOC_SQL = (
    f"SELECT id, slug, era, cpu_index, system_index, {mean([('cpu_index', 0.7), ('system_index', 0.3)])} AS overall FROM (SELECT id, slug, {era('release_date')} AS era, "
    f"{mean([('s', 0.4), ('m', 0.6)])} AS cpu_index, y AS system_index FROM (SELECT *, {cap('geekbench_single', SOC_SCALES['geekbench_single'])} AS s, {cap('geekbench_multi', SOC_SCALES['geekbench_multi'])} AS m, {cap('antutu_score', SOC_SCALES['antutu_score'])} AS y FROM {latest('socs')}))"
)


def _relative_of(cte: str, index: str, prefix: str) -> str:
    """As _relative, for one of several indexes; the percentile counts rows no better in the same era."""
    inside = f"{index} IS NOT NULL AND era IS NOT NULL"
    rows = f"SELECT era, {index} AS v, sum(count(*)) OVER (PARTITION BY era ORDER BY {index}) AS upto, sum(count(*)) OVER (PARTITION BY era) AS n FROM ({cte}) WHERE {inside} GROUP BY 1, 2"
    return f"SELECT t.*, {rnd('100.0::DOUBLE * c.upto / c.n')} AS {prefix}percentile, {tier_of(rnd('100.0::DOUBLE * c.upto / c.n'))} AS {prefix}tier, c.n::BIGINT AS {prefix}cohort FROM ({cte}) t LEFT JOIN ({rows}) c ON t.era = c.era AND t.{index} = c.v"


@query(_relative_of(_relative_of(_SOC_SQL, "cpu_index", "cpu_"), "system_index", "system_"))
def q03_soc_scores(spark, d):
    return scoring.soc_scores(socs(spark, d))


def _phone_sql() -> str:
    c = {n: cap(n, s) for n, s in PHONE_SCALES.items()}
    inner = (
        f"SELECT p.id, p.slug, p.msrp_usd, {era('p.release_date')} AS era, gs, gm, an, "
        f"({cap('p.ram_gb', PHONE_SCALES['ram_gb'])}) AS ram, {cap('p.battery_mah', PHONE_SCALES['battery_mah'])} AS bat, {cap('p.charging_wired_w', PHONE_SCALES['charging_wired_w'])} AS wired, {cap('p.charging_wireless_w', PHONE_SCALES['charging_wireless_w'])} AS wireless, eff, "
        "p.battery_mah, p.charging_wired_w, p.charging_wireless_w, p.display, p.cameras, coalesce(list_filter(p.cameras, lambda x: x.type = 'main')[1], p.cameras[1]) AS main "
        f"FROM {latest('smartphones')} p JOIN (SELECT id, {c['geekbench_single']} AS gs, {c['geekbench_multi']} AS gm, {c['antutu_score']} AS an, {c['process_nm']} AS eff FROM {latest('socs')}) s ON p.soc_id = s.id"
    )
    disp = "display.refresh_hz IS NOT NULL OR display.brightness_nits IS NOT NULL OR display.ppi IS NOT NULL"
    part = lambda n: f"coalesce({cap('display.' + n, PHONE_SCALES[n])}, 50.0::DOUBLE)"
    plug = lambda col, v: f"(CASE WHEN {col} IS NOT NULL AND {col} <> 0 THEN coalesce({v}, 0.0::DOUBLE) ELSE 0.0::DOUBLE END)"
    rear = "len(list_filter(cameras, lambda x: coalesce(x.type <> 'selfie', true)))"
    perf = mean([("gs", 0.25), ("gm", 0.30), ("an", 0.30), ("ram", 0.15)])
    camera_base = cap("main.mp", PHONE_SCALES["main_camera_mp"])
    camera = rnd(f"least(100.0::DOUBLE, ({camera_base}) * 0.6::DOUBLE + least({rear}, 4) / 4.0::DOUBLE * 20.0::DOUBLE + CASE WHEN main.ois THEN 8.0::DOUBLE ELSE 0.0::DOUBLE END)")
    wired, wireless = plug("charging_wired_w", "wired"), plug("charging_wireless_w", "wireless")
    battery = rnd(f"bat * 0.45::DOUBLE + {wired} * 0.20::DOUBLE + {wireless} * 0.10::DOUBLE + coalesce(eff, 50.0::DOUBLE) * 0.25::DOUBLE")
    refresh, nits, ppi = part("refresh_hz"), part("brightness_nits"), part("ppi")
    display = rnd(f"{refresh} * 0.35::DOUBLE + {nits} * 0.35::DOUBLE + {ppi} * 0.30::DOUBLE")
    axes = (
        f"SELECT id, slug, msrp_usd, era, CASE WHEN gs IS NOT NULL OR gm IS NOT NULL OR an IS NOT NULL THEN {perf} END AS performance, "
        f"CASE WHEN len(cameras) > 0 AND main.mp IS NOT NULL THEN {camera} END AS camera, "
        f"CASE WHEN battery_mah > 0 THEN {battery} END AS battery, "
        f"CASE WHEN {disp} THEN {display} END AS display FROM ({inner})"
    )
    overall = f"SELECT *, {mean([(n, 1.0) for n in ('performance', 'camera', 'battery', 'display')])} AS overall FROM ({axes})"
    worth = rnd(f"overall * 0.5::DOUBLE + ({cap('msrp_usd', PHONE_SCALES['msrp_usd'])}) * 0.5::DOUBLE")
    value = f"SELECT id, slug, era, performance, camera, battery, display, overall, CASE WHEN msrp_usd <> 0 AND overall IS NOT NULL THEN {worth} END AS value FROM ({overall})"
    return _relative(value, "performance", "id, slug, era, performance, camera, battery, display, overall, value")


@query(_phone_sql())
def q09_phone_scores(spark, d):
    p = phones(spark, d, "slug", "soc_id", "msrp_usd", "ram_gb", "release_date", "display", "cameras", "battery_mah", "charging_wired_w", "charging_wireless_w")
    return scoring.phone_scores(p, socs(spark, d))


# ---- Listings, joins, pages ---------------------------------------------------------


@query(f"SELECT s.slug, s.name, b.slug AS maker FROM {latest('socs')} s JOIN {latest('brands')} b ON s.manufacturer_id = b.id")
def j01_soc_maker(spark, d):
    b = brands(spark, d).select(F.col("id").alias("manufacturer_id"), F.col("slug").alias("maker"))
    return socs(spark, d).join(b, "manufacturer_id").select("slug", "name", "maker")


@query(
    f"SELECT p.id, p.slug, b.slug AS brand, s.slug AS soc, m.slug AS soc_maker FROM {latest('smartphones')} p JOIN {latest('brands')} b ON p.brand_id = b.id "
    f"JOIN {latest('socs')} s ON p.soc_id = s.id JOIN {latest('brands')} m ON s.manufacturer_id = m.id"
)
def j02_phone_detail(spark, d):
    b = brands(spark, d)
    s = socs(spark, d).join(b.select(F.col("id").alias("manufacturer_id"), F.col("slug").alias("soc_maker")), "manufacturer_id").select(F.col("id").alias("soc_id"), F.col("slug").alias("soc"), "soc_maker")
    return phones(spark, d, "slug", "brand_id", "soc_id").join(b.select(F.col("id").alias("brand_id"), F.col("slug").alias("brand")), "brand_id").join(s, "soc_id").select("id", "slug", "brand", "soc", "soc_maker")


@query(f"SELECT m.id, m.category, b.slug AS brand, s.slug AS soc FROM {latest('mobile_devices')} m JOIN {latest('brands')} b ON m.brand_id = b.id LEFT JOIN {latest('socs')} s ON m.soc_id = s.id")
def j03_mobile_detail(spark, d):
    m = counting_rows(table(spark, d, "mobile_devices"), "id", "updated_at", "category", "brand_id", "soc_id")
    b = brands(spark, d).select(F.col("id").alias("brand_id"), F.col("slug").alias("brand"))
    s = socs(spark, d).select(F.col("id").alias("soc_id"), F.col("slug").alias("soc"))
    return m.join(b, "brand_id").join(s, "soc_id", "left").select("id", "category", "brand", "soc")


@query(f"SELECT b.slug AS brand, count(*) AS devices, max(p.release_date) AS latest FROM {latest('brands')} b JOIN {latest('smartphones')} p ON p.brand_id = b.id GROUP BY 1")
def j07_brand_phones(spark, d):
    b = brands(spark, d).select(F.col("id").alias("brand_id"), F.col("slug").alias("brand"))
    return phones(spark, d, "brand_id", "release_date").join(b, "brand_id").groupBy("brand").agg(F.count(F.lit(1)).alias("devices"), F.max("release_date").alias("latest"))


@query("SELECT DISTINCT category, manufacturer, slug FROM ingest_candidates i WHERE batch_no > 0 AND NOT EXISTS (SELECT 1 FROM ingest_candidates h WHERE h.batch_no = 0 AND h.category = i.category AND h.manufacturer = i.manufacturer AND h.slug = i.slug)")
def j09_insert_if_absent(spark, d):
    i = table(spark, d, "ingest_candidates").select("batch_no", "category", "manufacturer", "slug")
    keys = ["category", "manufacturer", "slug"]
    return i.where("batch_no > 0").drop("batch_no").join(i.where("batch_no = 0").drop("batch_no"), keys, "left_anti").distinct()


@query("SELECT DISTINCT category, slug FROM coverage_points c WHERE slug IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ingest_candidates i WHERE i.category = c.category AND i.slug = c.slug)")
def j11_coverage_gap(spark, d):
    c = table(spark, d, "coverage_points").where("slug is not null").select("category", "slug").distinct()
    return c.join(table(spark, d, "ingest_candidates").select("category", "slug"), ["category", "slug"], "left_anti")


@query("SELECT point_id, category FROM coverage_points WHERE length(slug) >= 4 AND regexp_matches(slug, '[0-9]') AND NOT regexp_matches(slug, '^[0-9]+-[0-9]+$')")
def f03_probable_slug(spark, d):
    return table(spark, d, "coverage_points").where(parsers.probable_model_slug(F.col("slug"))).select("point_id", "category")


@query(f"SELECT id, slug FROM {latest('cpus')} WHERE segment = 'laptop' AND cores >= 8")
def f01_filters(spark, d):
    return cpus(spark, d, "slug", "segment", "cores").where("segment = 'laptop' and cores >= 8").select("id", "slug")


@query(f"SELECT id, slug, msrp_usd FROM {latest('smartphones')} ORDER BY msrp_usd DESC NULLS LAST, id LIMIT 20 OFFSET 40")
def o02_sort_page(spark, d):
    return records.page(phones(spark, d, "slug", "msrp_usd"), [F.col("msrp_usd").desc_nulls_last(), F.col("id")], 40, 20).select("id", "slug", "msrp_usd")


@query(f"SELECT brand_id, id, msrp_usd FROM {latest('smartphones')} WHERE brand_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY brand_id ORDER BY msrp_usd DESC NULLS LAST, id) <= 3")
def o05_topn_per_group(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("brand_id").orderBy(F.col("msrp_usd").desc_nulls_last(), "id")
    return phones(spark, d, "brand_id", "msrp_usd").where("brand_id is not null").withColumn("r", F.row_number().over(w)).where("r <= 3").select("brand_id", "id", "msrp_usd")


@query("SELECT manufacturer, count(*) AS n FROM coverage_points GROUP BY 1 ORDER BY n DESC, manufacturer NULLS LAST LIMIT 10")
def o06_most_common(spark, d):
    return table(spark, d, "coverage_points").groupBy("manufacturer").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col("manufacturer").asc_nulls_last()).limit(10)


# ---- Validation and signals ---------------------------------------------------------

@query("SELECT ingest_id, slug FROM ingest_candidates WHERE slug IS NOT NULL AND NOT regexp_full_match(slug, '[a-z0-9]+(-[a-z0-9]+)*')")
def v02_slug_shape(spark, d):
    return table(spark, d, "ingest_candidates").where(~F.col("slug").rlike("^[a-z0-9]+(?:-[a-z0-9]+)*$")).select("ingest_id", "slug")


@query("SELECT ingest_id, category, slug, first_value(ingest_id) OVER w AS first_id FROM ingest_candidates WHERE slug IS NOT NULL WINDOW w AS (PARTITION BY category, slug ORDER BY ingest_id) QUALIFY row_number() OVER w > 1")
def v05_duplicate_slugs(spark, d):
    i = table(spark, d, "ingest_candidates").where("slug is not null").select("ingest_id", "category", "slug")
    first = i.groupBy("category", "slug").agg(F.min("ingest_id").alias("first_id"))
    return i.join(first, ["category", "slug"]).where("ingest_id > first_id").select("ingest_id", "category", "slug", "first_id")


@query("SELECT ingest_id, split_part(output_path, '/', 1) AS category, split_part(output_path, '/', 2) AS maker, split_part(output_path, '/', 3) AS year, regexp_extract(output_path, '([^/]+)\\.json$', 1) AS stem FROM ingest_candidates")
def v07_path_parts(spark, d):
    p = F.split("output_path", "/")
    return table(spark, d, "ingest_candidates").select("ingest_id", F.get(p, F.lit(0)).alias("category"), F.get(p, F.lit(1)).alias("maker"), F.get(p, F.lit(2)).alias("year"), F.regexp_extract("output_path", r"([^/]+)\.json$", 1).alias("stem"))


@query(f"SELECT p.id, p.soc_id FROM {latest('smartphones')} p WHERE soc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM socs s WHERE s.id = p.soc_id)")
def v11_fk_anti(spark, d):
    s = table(spark, d, "socs").select(F.col("id").alias("soc_id"))
    return phones(spark, d, "soc_id").where("soc_id is not null").join(s, "soc_id", "left_anti").select("id", "soc_id")


_PPI = "sqrt(w * w + h * h) / size"


@query(
    f"SELECT id, CASE WHEN w IS NULL OR size IS NULL OR size <= 0 OR ppi IS NULL THEN 'na' WHEN abs({_PPI} - ppi) <= 0.15::DOUBLE * ppi THEN 'pass' ELSE 'fail' END AS result FROM (SELECT id, try_cast(nullif(regexp_extract(display.resolution, '(\\d{{2,5}})\\s*[x×]\\s*(\\d{{2,5}})', 1), '') AS DOUBLE) AS w, "
    f"try_cast(nullif(regexp_extract(display.resolution, '(\\d{{2,5}})\\s*[x×]\\s*(\\d{{2,5}})', 2), '') AS DOUBLE) AS h, display.size_inch AS size, display.ppi AS ppi FROM {latest('smartphones')})"
)
def g09_ppi(spark, d):
    r = parsers.resolution(F.col("display.resolution"))
    rows = phones(spark, d, "display").withColumn("r", r).withColumn("ppi", F.col("display.ppi")).withColumn("size", F.col("display.size_inch"))
    dense = F.sqrt(F.col("r.w").cast("double") ** 2 + F.col("r.h").cast("double") ** 2) / F.nullif(F.col("size"), F.lit(0.0))
    na = F.col("r").isNull() | F.col("size").isNull() | (F.col("size") <= 0) | F.col("ppi").isNull()
    return rows.select("id", F.when(na, "na").when(F.abs(dense - F.col("ppi")) <= 0.15 * F.col("ppi"), "pass").otherwise("fail").alias("result"))


@query(f"SELECT p.id, CASE WHEN p.release_date IS NULL OR s.release_date IS NULL THEN 'na' WHEN year(s.release_date) <= year(p.release_date) + CASE WHEN strftime(s.release_date, '%m-%d') = '01-01' THEN 2 ELSE 0 END THEN 'pass' ELSE 'fail' END AS result FROM {latest('smartphones')} p LEFT JOIN {latest('socs')} s ON p.soc_id = s.id")
def g13_soc_not_after(spark, d):
    s = socs(spark, d).select(F.col("id").alias("soc_id"), F.col("release_date").alias("sd"))
    slack = F.when(F.date_format("sd", "MM-dd") == "01-01", 2).otherwise(0)
    return phones(spark, d, "soc_id", "release_date").join(s, "soc_id", "left").select("id", F.when(F.col("release_date").isNull() | F.col("sd").isNull(), "na").when(F.year("sd") <= F.year("release_date") + slack, "pass").otherwise("fail").alias("result"))


_NOW_YEAR = 2026
_NO_URLS = "NULL::VARCHAR[]"


def _tier0_sql(category: str, source: str, rich: list[str], signals: list[tuple[str, bool]], urls: str = _NO_URLS, names: list[str] | None = None, wide: str = "") -> str:
    """As verify.tier0, over a source with id; ``rich`` and ``signals`` are conditions, ``wide`` further columns."""
    host = "regexp_replace(regexp_extract(lower(u), '^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)', 1), '^www\\.', '')"
    known = " ".join("WHEN regexp_matches(h, '(^|\\.)(" + "|".join(x.replace(".", "\\.") for x in hosts) + f")$') THEN {t}" for t, hosts in verify.TIER_HOSTS.items())
    tiers = f"list_transform(list_distinct(list_transform({urls}, lambda u: {host})), lambda h: CASE {known} ELSE 0 END)"
    count = lambda flags: " + ".join(f"coalesce({f}, false)::INT" for f in flags)
    if wide:
        hard_flags = ", ".join(f"CASE WHEN NOT ({x}) THEN '!{n}' END" for n, x in zip(names, (x for x, hard in signals if hard), strict=True))
        wide += f", list_filter([{hard_flags}]::VARCHAR[], lambda x: x IS NOT NULL) AS flags"
    cells = f"SELECT id, {wide + ', ' if wide else ''}{count(rich)} AS rich, {count(f'({s}) IS NOT NULL' for s, _ in signals)} AS asked, {count(s for s, _ in signals)} AS passed, {count(f'NOT ({s})' for s, hard in signals if hard) or '0'} AS hard, {tiers} AS tiers FROM ({source})"
    best = f"SELECT *, coalesce(list_min(list_filter(tiers, lambda t: t > 0)), 0) AS best_tier, coalesce(len(list_filter(tiers, lambda t: t IN (1, 2))), 0) AS strong FROM ({cells})"
    trust = "least(CASE best_tier WHEN 1 THEN 26.0::DOUBLE WHEN 2 THEN 18.0::DOUBLE WHEN 3 THEN 6.0::DOUBLE ELSE 3.0::DOUBLE END + CASE WHEN strong >= 2 THEN 4.0::DOUBLE ELSE 0.0::DOUBLE END, 30.0::DOUBLE)"
    total = f"SELECT *, 25.0::DOUBLE * rich / {float(len(rich))}::DOUBLE + CASE WHEN asked = 0 THEN 35.0::DOUBLE ELSE 35.0::DOUBLE * passed / asked::DOUBLE END + {trust} + 7.0::DOUBLE AS total FROM ({best})"
    band = "CASE WHEN hard > 0 THEN 'red' WHEN total >= 75 AND best_tier IN (1, 2) THEN 'green' WHEN total < 45 THEN 'red' ELSE 'yellow' END"
    more = ", slug, name, released, verified, '" + category + ":' || model AS model, flags" if wide else ""
    return f"SELECT '{category}' AS category, id, {band} AS band, {rnd('total')} AS total, best_tier{more} FROM ({total})"


#: The hard signals of a category, in order.
_HARD = {"cpu": ["threads_ge_cores", "boost_ge_base", "release_not_future"], "gpu": ["boost_ge_base", "release_not_future"], "soc": ["release_not_future"], "smartphone": ["release_not_future"], "brand": []}


def _q16_sql(wide: bool = False) -> str:
    text, has = lambda x: f"({x} IS NOT NULL AND {x} <> '')", lambda x: f"({x} IS NOT NULL)"
    dated = f"year(release_date) <= {_NOW_YEAR + 1}"
    shape = "'(\\d{2,5})\\s*[x×]\\s*(\\d{2,5})'"
    w, h = (f"try_cast(nullif(regexp_extract(display.resolution, {shape}, {g}), '') AS DOUBLE)" for g in (1, 2))
    major = "try_cast(nullif(regexp_extract(lower(os), 'android\\s*(\\d{1,2})', 1), '') AS INT)"
    android = f"CASE {major} " + " ".join(f"WHEN {v} THEN {y}" for v, y in verify.ANDROID_YEARS.items()) + " END"
    s = "storage_options_gb"
    phone = [
        (f"CASE WHEN display.size_inch > 0 THEN abs(sqrt({w} * {w} + {h} * {h}) / display.size_inch - display.ppi) <= 0.15::DOUBLE * display.ppi END", False),
        (f"CASE WHEN len({s}) > 0 THEN coalesce(list_min({s}) >= 1 AND {s} = list_sort(list_distinct({s})), false) END", False),
        (f"year(release_date) >= {android}", False),
        (dated, True),
        (f"ram_gb <= list_max({s})", False),
        ("year(soc_date) <= year(release_date) + CASE WHEN strftime(soc_date, '%m-%d') = '01-01' THEN 2 ELSE 0 END", False),
    ]
    more = {
        k: {"names": _HARD[k], "wide": f"slug, name, {'NULL::INT' if k == 'brand' else 'year(release_date)'} AS released, {'coalesce(verified, false)' if k in ('cpu', 'smartphone') else 'false'} AS verified, {model} AS model"} if wide else {}
        for k, model in {"cpu": "slug", "gpu": "slug", "soc": "slug", "smartphone": "CASE WHEN base_model_slug <> '' THEN coalesce(brand_id::VARCHAR, '') || '/' || base_model_slug ELSE slug END", "brand": "slug"}.items()
    }
    # Fields that the tables lack count as absent.
    parts = [
        _tier0_sql("cpu", f"SELECT * FROM {latest('cpus')}", [text("architecture"), has("base_clock_ghz"), has("boost_clock_ghz"), has("l3_cache_mb"), text("socket"), has("tdp_w"), "false"], [("threads >= cores", True), ("boost_clock_ghz >= base_clock_ghz", True), (dated, True)], **more["cpu"]),
        _tier0_sql("gpu", f"SELECT * FROM {latest('gpus')}", [text("architecture"), has("boost_clock_mhz"), text("memory_type"), *["false"] * 4], [("boost_clock_mhz >= base_clock_mhz", True), (dated, True)], **more["gpu"]),
        _tier0_sql("soc", f"SELECT * FROM {latest('socs')}", [text("cpu_config"), has("geekbench_multi"), *["false"] * 4], [(dated, True), ("NOT ((process_nm < 7 AND year(release_date) < 2017) OR (process_nm < 3 AND year(release_date) < 2022))", False), ("coalesce(trim(gpu_name) <> '', false)", False)], **more["soc"]),
        _tier0_sql("smartphone", f"SELECT p.*, s.release_date AS soc_date FROM {latest('smartphones')} p LEFT JOIN {latest('socs')} s ON p.soc_id = s.id", [has("soc_id"), has("display.size_inch"), text("display.resolution"), has("display.ppi"), "(len(cameras) > 0)", f"(len({s}) > 0)", has("charging_wired_w"), "false"], phone, "source_urls", **more["smartphone"]),
        _tier0_sql("brand", f"SELECT * FROM {latest('brands')}", [has("founded_year"), "false"], [(f"founded_year <= {_NOW_YEAR}", False)], "source_urls", **more["brand"]),
    ]
    return " UNION ALL ".join(parts)


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """(category, id, slug, name, released, verified, model, flags, band, total, best_tier) of the catalog's records."""
    c, year, none = F.col, F.year("release_date"), F.lit(False)
    text, has = lambda n: c(n).isNotNull() & (c(n) != ""), lambda n: c(n).isNotNull()
    no_urls, dated = F.lit(None).cast("array<string>"), (year <= _NOW_YEAR + 1, True)
    gpus = counting_rows(table(spark, d, "gpus"), "id", "updated_at", "architecture", "boost_clock_mhz", "base_clock_mhz", "memory_type", "release_date", "slug", "name")
    chips = counting_rows(table(spark, d, "socs"), "id", "updated_at", "cpu_config", "geekbench_multi", "process_nm", "gpu_name", "release_date", "slug", "name")
    p = phones(spark, d, "slug", "name", "base_model_slug", "brand_id", "verified", "soc_id", "release_date", "ram_gb", "storage_options_gb", "display", "cameras", "charging_wired_w", "os", "source_urls")
    p = p.join(chips.select(c("id").alias("soc_id"), c("release_date").alias("soc_date")), "soc_id", "left")
    early = ((c("process_nm") < 7) & (year < 2017)) | ((c("process_nm") < 3) & (year < 2022))
    parts = {
        "cpu": (cpus(spark, d, "slug", "name", "verified", "architecture", "base_clock_ghz", "boost_clock_ghz", "l3_cache_mb", "socket", "tdp_w", "threads", "cores", "release_date"), [text("architecture"), has("base_clock_ghz"), has("boost_clock_ghz"), has("l3_cache_mb"), text("socket"), has("tdp_w"), none], [(c("threads") >= c("cores"), True), (c("boost_clock_ghz") >= c("base_clock_ghz"), True), dated], no_urls),
        "gpu": (gpus, [text("architecture"), has("boost_clock_mhz"), text("memory_type"), *[none] * 4], [(c("boost_clock_mhz") >= c("base_clock_mhz"), True), dated], no_urls),
        "soc": (chips, [text("cpu_config"), has("geekbench_multi"), *[none] * 4], [dated, (~early, False), (F.coalesce(F.trim("gpu_name") != "", none), False)], no_urls),
        "smartphone": (p, [has("soc_id"), has("display.size_inch"), text("display.resolution"), has("display.ppi"), F.size("cameras") > 0, F.size("storage_options_gb") > 0, has("charging_wired_w"), none], verify.phone_signals(_NOW_YEAR), c("source_urls")),
        "brand": (brands(spark, d), [has("founded_year"), none], [(c("founded_year") <= _NOW_YEAR, False)], c("source_urls")),
    }
    out = None
    for category, (rows, rich, signals, urls) in parts.items():
        model = c("slug")
        if category == "smartphone":
            model = F.when(c("base_model_slug") != "", F.concat(F.coalesce(c("brand_id").cast("string"), F.lit("")), F.lit("/"), "base_model_slug")).otherwise(model)
        released = year if "release_date" in rows.columns else F.lit(None).cast("int")
        verified = F.coalesce("verified", none) if "verified" in rows.columns else none
        one = rows.select(F.lit(category).alias("category"), "id", "slug", "name", released.alias("released"), verified.alias("verified"), F.concat(F.lit(f"{category}:"), model).alias("model"), verify.failed(signals, _HARD[category]).alias("flags"), verify.tier0(rich, signals, urls).alias("s"))
        one = one.select(*[n for n in one.columns if n != "s"], "s.*")
        out = one if out is None else out.unionByName(one)
    return out


@query(_q16_sql())
def q16_bands(spark, d):
    return _scored(spark, d).select("category", "id", "band", "total", "best_tier")


_SCORED_SQL = f"(SELECT * FROM ({_q16_sql(wide=True)}) WHERE slug <> '')"


@query(
    "SELECT *, " + rnd("CASE WHEN total > 0 THEN 100.0::DOUBLE * verified / total ELSE 0 END", 2) + " AS verified_pct, " + rnd("CASE WHEN models > 0 THEN 100.0::DOUBLE * verified_models / models ELSE 0 END", 2) + " AS verified_models_pct, green AS promotable FROM ("
    "SELECT coalesce(category, 'ALL') AS category, count(*) AS total, count(*) FILTER (verified) AS verified, count(DISTINCT model) AS models, count(DISTINCT model) FILTER (verified) AS verified_models, "
    "count(*) FILTER (band = 'green') AS green, count(*) FILTER (band = 'yellow') AS yellow, count(*) FILTER (band = 'red') AS red FROM " + _SCORED_SQL + " GROUP BY ROLLUP (category))"
)
def a10_verified_rollup(spark, d):
    is_ = lambda band: F.count_if(F.col("band") == band).alias(band)
    share = lambda part, whole: py_round(F.when(F.col(whole) > 0, 100.0 * F.col(part) / F.col(whole)).otherwise(0.0), 2)
    s = _scored(spark, d).where("slug <> ''").rollup("category").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("verified").alias("verified"), F.count_distinct("model").alias("models"), F.count_distinct(F.when(F.col("verified"), F.col("model"))).alias("verified_models"), is_("green"), is_("yellow"), is_("red")
    )
    s = s.withColumn("verified_pct", share("verified", "total")).withColumn("verified_models_pct", share("verified_models", "models"))
    return s.withColumn("promotable", F.col("green")).withColumn("category", F.coalesce("category", F.lit("ALL")))


@query("SELECT coalesce(category, 'ALL') AS category, count(*) FILTER (band = 'green') AS green, count(*) FILTER (band = 'yellow') AS yellow, count(*) FILTER (band = 'red') AS red, count(*) AS total FROM " + _SCORED_SQL + " GROUP BY ROLLUP (category)")
def a11_band_histogram(spark, d):
    s = _scored(spark, d).where("slug <> ''").rollup("category").agg(*[F.count_if(F.col("band") == b).alias(b) for b in ("green", "yellow", "red")], F.count(F.lit(1)).alias("total"))
    return s.withColumn("category", F.coalesce("category", F.lit("ALL")))


@query("SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM " + _SCORED_SQL + ") GROUP BY 1 ORDER BY n DESC, flag LIMIT 10")
def a11_top_flags(spark, d):
    return _scored(spark, d).where("slug <> ''").select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "flag").limit(10)


_HEADING = "regexp_replace(lower({x}), '[^a-z0-9]+', '', 'g')"


@query(
    f"WITH r AS (SELECT category, id, band, released, {_HEADING.format(x='name')} AS n FROM {_SCORED_SQL} WHERE NOT verified), c AS (SELECT candidate_id, release_year, {_HEADING.format(x='title')} AS h FROM crossref_candidates), "
    "m AS (SELECT category, id, arg_min(release_year, (CASE WHEN release_year IS NULL THEN 1 ELSE 0 END, candidate_id)) AS found FROM r JOIN c ON n <> '' AND h <> '' AND (n = h OR (length(h) >= 4 AND (ends_with(n, h) OR ends_with(h, n)))) GROUP BY 1, 2), "
    "x AS (SELECT r.category, r.id, r.band, CASE WHEN m.id IS NULL THEN 'notfound' WHEN m.found IS NULL OR r.released IS NULL THEN 'ambiguous' WHEN abs(r.released - m.found) <= 1 THEN 'confirm' ELSE 'contradict' END AS decision FROM r LEFT JOIN m ON r.category = m.category AND r.id = m.id) "
    "SELECT *, coalesce(decision = 'confirm' OR (decision <> 'contradict' AND band = 'green'), false) AS promote, CASE WHEN decision = 'contradict' THEN 'crossref-contradict' WHEN decision = 'confirm' THEN 'crossref-confirm' WHEN band = 'green' THEN 'green' ELSE 'needs-confirmation' END AS reason FROM x"
)
def q19_promotions(spark, d):
    # Read five times below: scored once into a written table.
    r = _scored(spark, d).where("slug <> '' and not verified").select(F.concat_ws(":", "category", "id").alias("record_id"), "category", "id", "band", "name", F.col("released").alias("year"))
    r = cut(r, "q19-records")
    entries = table(spark, d, "crossref_candidates").select("title", F.col("candidate_id").alias("rank"), F.col("release_year").alias("year"))
    decisions = verify.crossref(r, cut(verify.found_headings(r, entries), "q19-found"))
    return r.join(decisions, "record_id").select("category", "id", "band", "decision", verify.promotion(F.col("band"), F.col("decision")).alias("p")).select("category", "id", "band", "decision", "p.promote", "p.reason")


# ---- Aggregates and windows ---------------------------------------------------------


@query("SELECT category, manufacturer, count(DISTINCT slug) AS slugs, arg_min(name, point_id) AS first_name FROM coverage_points WHERE slug IS NOT NULL GROUP BY 1, 2")
def a12_first_meta_per_key(spark, d):
    return table(spark, d, "coverage_points").where("slug is not null").groupBy("category", "manufacturer").agg(F.count_distinct("slug").alias("slugs"), F.min_by("name", "point_id").alias("first_name"))


@query("SELECT category, slug, count(*) AS n FROM coverage_points WHERE slug IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1")
def a13_duplicates(spark, d):
    return table(spark, d, "coverage_points").where("slug is not null").groupBy("category", "slug").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT y, median(s) AS median_sum FROM (SELECT year(o_orderdate) AS y, o_orderkey, sum(l_extendedprice) AS s FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2) GROUP BY 1")
def a06_sum_then_median(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    sums = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("s"))
    return records.medians(o.join(sums, "o_orderkey"), ["y"], "s", "median_sum").select("y", "median_sum")


@query("SELECT l_partkey, max(l_extendedprice) AS best FROM lineitem GROUP BY 1")
def a07_max_by_key(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.max("l_extendedprice").alias("best"))


@query("SELECT p_brand, n, s[round_even(0.01::DOUBLE * (n - 1), 0)::INT + 1] AS lo, s[round_even(0.99::DOUBLE * (n - 1), 0)::INT + 1] AS hi FROM (SELECT p_brand, count(p_retailprice) AS n, list_sort(list(p_retailprice)) AS s FROM part GROUP BY 1) WHERE n >= 5")
def a08_nearest_rank_bounds(spark, d):
    return records.rank_bounds(table(spark, d, "part"), ["p_brand"], "p_retailprice")


@query(
    "WITH r AS (SELECT id, architecture, ln(boost_clock_mhz / base_clock_mhz) AS r FROM " + latest("gpus") + " WHERE boost_clock_mhz / base_clock_mhz > 0), m AS (SELECT architecture, median(r) AS m, count(*) AS n FROM r GROUP BY 1), "
    "v AS (SELECT r.*, m.n, abs(r.r - m.m) AS d FROM r JOIN m USING (architecture)), s AS (SELECT architecture, median(d) AS mad FROM v GROUP BY 1) "
    f"SELECT id, architecture, {rnd('r', 4)} AS log_ratio, {rnd('exp(r)', 2)} AS ratio FROM v JOIN s USING (architecture) WHERE n >= 8 AND d > 4 * CASE WHEN mad = 0 THEN 1e-9 ELSE mad END"
)
def a09_mad_outliers(spark, d):
    g = counting_rows(table(spark, d, "gpus"), "id", "updated_at", "architecture", "boost_clock_mhz", "base_clock_mhz")
    return records.mad_outliers(g, ["id"], F.col("boost_clock_mhz") / F.nullif(F.col("base_clock_mhz"), F.lit(0.0)), ["architecture"])


@query("SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2")
def w03_latest_by_key(spark, d):
    return records.last_by_key(table(spark, d, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


@query("SELECT category, slug, min(ingest_id) AS ingest_id, arg_min(output_path, ingest_id) AS output_path FROM ingest_candidates WHERE slug IS NOT NULL GROUP BY 1, 2")
def w04_first_wins(spark, d):
    return records.first_by_key(table(spark, d, "ingest_candidates").where("slug is not null").select("category", "slug", "ingest_id", "output_path"), ["category", "slug"], "ingest_id")


@query("SELECT output_path, max(file_id) AS file_id, arg_max(n_bytes, file_id) AS n_bytes FROM draft_files WHERE output_path IS NOT NULL GROUP BY 1")
def w05_last_wins(spark, d):
    return records.last_by_key(table(spark, d, "draft_files").where("output_path is not null").select("output_path", "file_id", "n_bytes"), ["output_path"], "file_id")


@query("SELECT lower(title) AS heading, arg_min(candidate_id, (CASE WHEN release_year IS NULL THEN 1 ELSE 0 END, candidate_id)) AS candidate_id FROM crossref_candidates GROUP BY 1")
def w07_best_candidate(spark, d):
    c = table(spark, d, "crossref_candidates")
    return c.groupBy(F.lower("title").alias("heading")).agg(F.min_by("candidate_id", F.struct(F.col("release_year").isNull(), "candidate_id")).alias("candidate_id"))


@query(
    f"SELECT p.id, coalesce(p.weight_g, m.w) AS weight_g, coalesce(p.msrp_usd, m.u) AS msrp_usd, CASE WHEN p.weight_g IS NOT NULL AND p.msrp_usd IS NOT NULL THEN 'already' WHEN (p.weight_g IS NULL AND m.w IS NOT NULL) OR (p.msrp_usd IS NULL AND m.u IS NOT NULL) THEN 'filled' ELSE 'unresolved' END AS outcome "
    f"FROM {latest('smartphones')} p LEFT JOIN (SELECT base_model_slug, max(weight_g) AS w, max(msrp_usd) AS u FROM {latest('smartphones')} GROUP BY 1) m ON p.base_model_slug = m.base_model_slug"
)
def q13_fill_only_nulls(spark, d):
    p = phones(spark, d, "base_model_slug", "weight_g", "msrp_usd")
    known = p.groupBy("base_model_slug").agg(F.max("weight_g").alias("weight_g"), F.max("msrp_usd").alias("msrp_usd"))
    return records.fill_nulls(p, known, "base_model_slug", ["weight_g", "msrp_usd"]).select("id", "weight_g", "msrp_usd", "outcome")


# ---- Sets ---------------------------------------------------------------------------


@query("SELECT category, slug FROM coverage_points UNION ALL SELECT category, slug FROM ingest_candidates")
def u01_union_all(spark, d):
    return table(spark, d, "coverage_points").select("category", "slug").unionByName(table(spark, d, "ingest_candidates").select("category", "slug"))


@query("SELECT DISTINCT lower(regexp_extract(url, '^[a-z]+://([^/]+)', 1)) AS host FROM crossref_candidates")
def u02_distinct_hosts(spark, d):
    return table(spark, d, "crossref_candidates").select(parsers.host_of(F.col("url")).alias("host")).distinct()


@query("SELECT slug FROM coverage_points WHERE slug IS NOT NULL EXCEPT SELECT slug FROM cpus")
def u03_except(spark, d):
    return table(spark, d, "coverage_points").where("slug is not null").select("slug").distinct().join(table(spark, d, "cpus").select("slug"), "slug", "left_anti")


@query("SELECT host, path, min(candidate_id) AS candidate_id FROM (SELECT candidate_id, lower(regexp_extract(url, '^[a-z]+://([^/]+)', 1)) AS host, regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS path FROM crossref_candidates) WHERE host <> '' GROUP BY 1, 2")
def u04_url_dedupe(spark, d):
    path = F.regexp_replace(F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1), "/+$", "")
    c = table(spark, d, "crossref_candidates").select("candidate_id", parsers.host_of(F.col("url")).alias("host"), path.alias("path"))
    return c.where("host <> ''").groupBy("host", "path").agg(F.min("candidate_id").alias("candidate_id"))


# ---- Scalar functions ---------------------------------------------------------------


@query("SELECT point_id, regexp_replace(lower(name), '[^a-z0-9]+', '', 'g') AS heading FROM coverage_points")
def x07_heading(spark, d):
    return table(spark, d, "coverage_points").select("point_id", text.normalize_heading(F.col("name")).alias("heading"))


@query(
    "SELECT point_id, regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(name), '\\s*@\\s*[\\d.]+\\s*ghz', '', 'gi'), '\\s*(?:w/|with)\\s+.*$', '', 'gi'), '\\b(processor|cpu)\\b', '', 'gi'), "
    "'\\b(black edition|extreme edition|(?:dual|two|quad|four|six|eight|ten|twelve|sixteen|\\d+)[- ]core)\\b', '', 'gi'), '\\s*\\([^)]*\\)', '', 'g')), '[^a-z0-9]+', '', 'g') AS key FROM coverage_points"
)
def x02_cpu_key(spark, d):
    return table(spark, d, "coverage_points").select("point_id", parsers.cpu_key(F.col("name")).alias("key"))


@query(
    "SELECT point_id, regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(name, '\\s*\\([^)]*\\)', '', 'g'), '/.*$', '', 'g'), '\\b\\d+\\s*gb\\b', '', 'gi'), '\\b(nvidia|amd|ati|intel|geforce|radeon|graphics|gpu|series|edition)\\b', ' ', 'gi')), '[^a-z0-9]+', '', 'g') AS key FROM coverage_points WHERE category = 'gpu'"
)
def x05_gpu_key(spark, d):
    return table(spark, d, "coverage_points").where("category = 'gpu'").select("point_id", parsers.gpu_key(F.col("name")).alias("key"))


@query(
    "SELECT id, CASE WHEN regexp_matches(l, 'xeon|epyc|altra|ampereone|opteron') THEN 'server' WHEN contains(l, 'threadripper') THEN 'hedt' WHEN regexp_matches(x, '[huypm]') AND NOT contains(x, 'k') THEN 'laptop' WHEN x IN ('x', 'xe') THEN 'hedt' ELSE 'desktop' END AS segment "
    f"FROM (SELECT id, lower(name) AS l, regexp_extract(lower(name), '\\b\\d{{3,5}}([a-z]{{1,3}})\\b', 1) AS x FROM {latest('cpus')} WHERE name IS NOT NULL)"
)
def x15_cpu_segment(spark, d):
    return cpus(spark, d, "name").where("name is not null").select("id", parsers.cpu_segment(F.col("name")).alias("segment"))


_READ = "regexp_extract(value_text, '(\\d+(?:\\.\\d+)?)\\s*({u})\\b', {g}, 'i')"
_NUM = "try_cast(nullif({x}, '') AS DOUBLE)"


@query(
    f"SELECT reading_id, CASE lower({_READ.format(u='MHz|GHz', g=2)}) WHEN 'ghz' THEN {_NUM.format(x=_READ.format(u='MHz|GHz', g=1))} WHEN 'mhz' THEN {rnd(_NUM.format(x=_READ.format(u='MHz|GHz', g=1)) + ' / 1000', 3)} END AS ghz, "
    f"CASE lower({_READ.format(u='MB|KB|GB', g=2)}) WHEN 'mb' THEN {_NUM.format(x=_READ.format(u='MB|KB|GB', g=1))} WHEN 'kb' THEN {rnd(_NUM.format(x=_READ.format(u='MB|KB|GB', g=1)) + ' / 1024', 4)} WHEN 'gb' THEN {_NUM.format(x=_READ.format(u='MB|KB|GB', g=1))} * 1024 END AS mb, "
    "try_cast(nullif(regexp_extract(value_text, '(\\d{1,5})', 1), '') AS INT) AS first_int FROM spec_readings"
)
def n01_spec_parsers(spark, d):
    v = F.col("value_text")
    return table(spark, d, "spec_readings").select("reading_id", parsers.frequency_ghz(v).alias("ghz"), parsers.cache_mb(v).alias("mb"), parsers.first_int(v).alias("first_int"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def c01_json_path(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


_STORE = "storage_options_gb"


@query(f"SELECT id, CASE WHEN {_STORE} IS NULL OR len({_STORE}) = 0 THEN 'na' WHEN list_min({_STORE}) >= 1 AND {_STORE} = list_sort(list_distinct({_STORE})) THEN 'pass' ELSE 'fail' END AS storage_sane FROM {latest('smartphones')}")
def c04_sorted_unique(spark, d):
    s = F.col(_STORE)
    return phones(spark, d, _STORE).select("id", F.when(s.isNull() | (F.size(s) == 0), "na").when((F.array_min(s) >= 1) & (s == F.array_sort(F.array_distinct(s))), "pass").otherwise("fail").alias("storage_sane"))


