"""Queries of the parsers of texts, over spec_readings, names of the catalog and a list of forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions import parsers, text
from specloom.plans.catalog import latest, query, rnd
from specloom.plans.reads import inline
from specloom.sources.tables import counting_rows, table

# Forms that the tables' texts lack; both engines read this text.
FORMS = """(VALUES
 (1, '3.9 GHz', 'volt'), (2, '1725 MHz boost', 'apple'), (3, '65/105 W', 'apple'), (4, '45W TDP', 'saro'), (5, '8 / 16', 'saro'), (6, '12', 'saro'), (7, '6 GB or 12GB RAM', 'saro'), (8, '768 MB', 'saro'), (9, '256-bit bus', 'saro'), (10, '192 bit', 'saro'),
 (11, 'PCIe 4.0 x16', 'saro'), (12, 'PCI-E Gen 5', 'saro'), (13, 'pci 3', 'saro'), (14, '4,500 mAh', 'saro'), (15, '90 mAh', 'saro'), (16, '13000 m A h', 'saro'), (17, '187.6 g', 'saro'), (18, '1,200 g', 'saro'), (19, '49 g', 'saro'), (20, '', 'apple'),
 (21, 'iPadOS 17.1', 'apple'), (22, 'iOS 16', 'apple'), (23, 'Android 13, One UI 5.1', 'saro'), (24, 'Windows Phone 8.1', 'saro'), (25, 'Orbis 4', 'apple'), (26, 'Orbis 4', ''), (27, 'HarmonyOS 3', 'saro'),
 (28, 'Snapgragon 8 for Orbit', 'saro'), (29, 'Qualcomm Snapgragon 7 (4 nm)', 'saro'), (30, 'MediaTek Density 900 mobile platform', 'saro'), (31, 'Apple A9', 'apple'),
 (32, 'Rack 220 (Acme Xe 5650)', 'saro'), (33, 'Box (old) (Acme Xe 26 v3, 2.30 GHz)', 'saro'), (34, 'Box ()', 'saro'),
 (35, 'Quadro P4000', 'saro'), (36, 'Radeon Pro W5', 'saro'), (37, 'Card 970', 'saro'), (38, 'Data Center Card', 'saro'),
 (39, '2023-04-05', 'saro'), (40, '2023/04/05', 'saro'), (41, 'April 5, 2023', 'saro'), (42, '5 april 2023', 'saro'), (43, 'Q3 2021', 'saro'), (44, 'Q2 ''19', 'saro'), (45, 'launched in 2018 or so', 'saro'), (46, '2023-02-30', 'saro'), (47, 'February 30, 2020', 'saro'), (48, ' 2024-12-31 ', 'saro'), (49, 'Q5 2020', 'saro'), (50, '1850', 'saro'), (51, NULL, 'saro'),
 (52, 'Kore Ix-9 K (Lake)', 'saro'), (53, 'Volt Rizen 9 16-Core Processor @ 4.2GHz', 'volt'), (54, 'Volt  Rizen 7 with Graphics', 'volt'), (55, '2.01 GHz', 'saro'), (56, '3 kg', 'saro'), (57, '1 GB / 0.5 GB', 'saro')
) AS t(i, v, brand)"""


def _forms(spark: SparkSession) -> DataFrame:
    return inline(spark, FORMS)


def _x(p: str, g: int = 1, of: str = "v") -> str:
    return f"nullif(regexp_extract({of}, '{p}', {g}, 'i'), '')"


_FREQ, _MEM = "(\\d+(?:\\.\\d+)?)\\s*(MHz|GHz)\\b", "(\\d+(?:\\.\\d+)?)\\s*(GB|MB)\\b"
_TEXTS = f"(SELECT i, v FROM {FORMS} UNION ALL SELECT 1000 + reading_id, value_text FROM spec_readings)"


def _texts(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "spec_readings").select((F.col("reading_id") + 1000).alias("i"), F.col("value_text").alias("v"))
    return _forms(spark).select(F.col("i").cast("bigint").alias("i"), "v").unionByName(s)


@query(f"SELECT i, CASE lower({_x(_FREQ, 2)}) WHEN 'ghz' THEN trunc({_x(_FREQ)}::DOUBLE * 1000)::INT WHEN 'mhz' THEN trunc({_x(_FREQ)}::DOUBLE)::INT END AS mhz FROM {_TEXTS}")
def n02_frequency_mhz(spark, d):
    return _texts(spark, d).select("i", parsers.frequency_mhz(F.col("v")).alias("mhz"))


@query(f"SELECT i, {_x('(\\d{1,4})(?:\\s*/\\s*\\d{1,4})?\\s*W\\b')}::INT AS w FROM {_TEXTS}")
def n03_tdp(spark, d):
    return _texts(spark, d).select("i", parsers.tdp_w(F.col("v")).alias("w"))


@query(f"SELECT i, try_cast(regexp_extract_all(v, '\\d+')[1] AS INT) AS cores, coalesce(try_cast(regexp_extract_all(v, '\\d+')[2] AS INT), try_cast(regexp_extract_all(v, '\\d+')[1] AS INT)) AS threads FROM {_TEXTS}")
def n06_cores_threads(spark, d):
    return _texts(spark, d).select("i", parsers.cores_threads(F.col("v")).alias("c")).select("i", "c.cores", "c.threads")


@query(f"SELECT i, CASE lower({_x(_MEM, 2)}) WHEN 'gb' THEN {_x(_MEM)}::DOUBLE WHEN 'mb' THEN {rnd(_x(_MEM) + '::DOUBLE / 1024', 3)} END AS gb FROM {_TEXTS}")
def n07_memory_gb(spark, d):
    return _texts(spark, d).select("i", parsers.memory_gb(F.col("v")).alias("gb"))


@query(f"SELECT i, {_x('(\\d{2,4})\\s*-?\\s*bit\\b')}::INT AS bits, {_x('PCI[-\\s]?[Ee]?\\s*(?:Gen\\s*)?(\\d(?:\\.\\d)?)')} AS pcie FROM {FORMS}")
def n08_bus_and_pcie(spark, d):
    """N08 and N09."""
    return _forms(spark).select("i", parsers.memory_bus_bit(F.col("v")).alias("bits"), parsers.pcie_version(F.col("v")).alias("pcie"))


@query(f"SELECT i, list_max(list_filter(list_transform(regexp_extract_all(v, '(\\d{{1,3}}(?:\\.\\d+)?)\\s*GB\\b', 1, 'i'), lambda x: x::DOUBLE), lambda x: x >= 1))::INT AS gb FROM {_TEXTS}")
def n10_ram(spark, d):
    return _texts(spark, d).select("i", parsers.ram_gb(F.col("v")).alias("gb"))


@query(f"SELECT i, CASE WHEN b BETWEEN 500 AND 12000 THEN b END AS mah, CASE WHEN g BETWEEN 50 AND 500 THEN g END AS grams FROM (SELECT i, {_x('(\\d{3,5})\\s*m\\s*A\\s*h\\b', 1, 'w')}::INT AS b, trunc(nullif(regexp_extract(w, '(\\d{{1,3}}(?:\\.\\d+)?)\\s*g\\b', 1), '')::DOUBLE)::INT AS g FROM (SELECT i, replace(v, ',', '') AS w FROM {FORMS}))")
def n11_battery_and_weight(spark, d):
    """N11 and N12."""
    return _forms(spark).select("i", parsers.battery_mah(F.col("v")).alias("mah"), parsers.weight_g(F.col("v")).alias("grams"))


_MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"
_LONG, _SHORT = f"\\b({_MONTHS})\\s+(\\d{{1,2}}),?\\s+(\\d{{4}})\\b", f"\\b(\\d{{1,2}})\\s+({_MONTHS})\\s+(\\d{{4}})\\b"
_QUARTER = "\\bQ([1-4])\\s*''?(\\d{4}|\\d{2})\\b"


def _date(t: str) -> str:
    g = lambda p, k: f"regexp_extract({t}, '{p}', {k}, 'i')"
    has = lambda p: f"regexp_matches({t}, '{p}', 'i')"
    year = f"CASE WHEN length({g(_QUARTER, 2)}) = 2 THEN '20' || {g(_QUARTER, 2)} ELSE {g(_QUARTER, 2)} END"
    return (
        f"CASE WHEN regexp_full_match({t}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_strptime({t}, '%Y-%m-%d')::DATE WHEN regexp_full_match({t}, '\\d{{4}}/\\d{{2}}/\\d{{2}}') THEN try_strptime({t}, '%Y/%m/%d')::DATE "
        f"WHEN {has(_LONG)} THEN try_strptime({g(_LONG, 1)} || ' ' || {g(_LONG, 2)} || ' ' || {g(_LONG, 3)}, '%B %d %Y')::DATE WHEN {has(_SHORT)} THEN try_strptime({g(_SHORT, 2)} || ' ' || {g(_SHORT, 1)} || ' ' || {g(_SHORT, 3)}, '%B %d %Y')::DATE "
        f"WHEN {has(_QUARTER)} THEN try_strptime(({year}) || '-' || (({g(_QUARTER, 1)}::INT - 1) * 3 + 1) || '-1', '%Y-%m-%d')::DATE WHEN {has('\\b(19\\d{2}|20\\d{2})\\b')} THEN try_strptime({g('\\b(19\\d{2}|20\\d{2})\\b', 1)} || '-01-01', '%Y-%m-%d')::DATE END"
    )


@query(f"SELECT i, {_date('trim(v)')} AS d FROM {FORMS} UNION ALL SELECT 1000 + ingest_id, {_date('trim(t)')} FROM (SELECT ingest_id, json_extract_string(record, '$.release_date') AS t FROM ingest_candidates WHERE json_valid(record))")
def d01_dates(spark, d):
    """All forms of a date, and whatever the drafts have for one."""
    i = table(spark, d, "ingest_candidates").where(F.try_parse_json("record").isNotNull()).select((F.col("ingest_id") + 1000).alias("i"), F.get_json_object("record", "$.release_date").alias("v"))
    return _forms(spark).select(F.col("i").cast("bigint").alias("i"), "v").unionByName(i).select("i", parsers.date(F.col("v")).alias("d"))


@query("SELECT ingest_id, CASE WHEN regexp_matches(t, '^\\d{4}') THEN left(t, 4)::INT END AS y FROM (SELECT ingest_id, json_extract_string(record, '$.release_date') AS t FROM ingest_candidates WHERE json_valid(record))")
def d02_year_of(spark, d):
    """The first four characters of a text as a year, where they are digits."""
    i = table(spark, d, "ingest_candidates").where(F.try_parse_json("record").isNotNull())
    return i.select("ingest_id", parsers.year_of(F.get_json_object("record", "$.release_date")).alias("y"))


_FOLD = "regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')"
_SLUG = "regexp_replace(regexp_replace({x}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


_NO_MAKER = "CASE WHEN lower(trim(v)) IN ('volt', 'apple') THEN '' ELSE regexp_replace(lower(trim(v)), '^(volt|apple) ', '') END"


@query(f"SELECT id, {_SLUG.format(x='lower(trim(' + _FOLD.format(x='name') + '))')} AS s FROM {latest('brands')} WHERE name IS NOT NULL UNION ALL SELECT 100000 + i, {_SLUG.format(x=_NO_MAKER)} FROM {FORMS} WHERE v IS NOT NULL")
def x01_slugs(spark, d):
    b = counting_rows(table(spark, d, "brands"), "id", "updated_at", "name").where("name is not null").select("id", text.slugify(F.col("name")).alias("s"))
    return b.unionByName(_forms(spark).where("v is not null").select((F.col("i") + 100000).cast("bigint").alias("id"), text.slugify(F.col("v"), ("volt", "apple")).alias("s")))


_SOC_TEXT = "regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(v, '\\s+for\\s+\\w+\\b', '', 'gi'), '\\s+\\(.+?\\)\\s*$', '', 'g'), '\\s+mobile\\s+platform\\b', '', 'gi')), '^(qualcomm|mediatek|samsung|huawei|google|apple) ', '', 'i')"


@query(f"SELECT i, {_SLUG.format(x=f'lower(trim({_SOC_TEXT}))')} AS slug FROM {FORMS}")
def x08_soc_slug(spark, d):
    return _forms(spark).select("i", parsers.soc_slug(F.col("v")).alias("slug"))


@query(f"SELECT i, s.id AS soc_id FROM (SELECT i, {_SLUG.format(x=f'lower(trim({_SOC_TEXT}))')} AS slug FROM (SELECT point_id AS i, name AS v FROM coverage_points WHERE category = 'soc')) f LEFT JOIN (SELECT slug, min(id) AS id FROM {latest('socs')} GROUP BY 1) s ON f.slug = s.slug")
def j13_soc_of_text(spark, d):
    """A chip written as text refers to the catalog's chip of that slug, or to none."""
    p = table(spark, d, "coverage_points").where("category = 'soc'").select(F.col("point_id").alias("i"), parsers.soc_slug(F.col("name")).alias("slug"))
    s = counting_rows(table(spark, d, "socs"), "id", "updated_at", "slug").groupBy("slug").agg(F.min("id").alias("soc_id"))
    return p.join(s, "slug", "left").select("i", "soc_id")


@query(f"SELECT i, nullif(trim(regexp_replace(list_last(regexp_extract_all(v, '\\(([^()]*)\\)', 1)), ',\\s*[\\d.]+\\s*[GM]Hz\\s*$', '', 'i')), '') AS cpu FROM {FORMS}")
def x09_processor(spark, d):
    return _forms(spark).select("i", parsers.processor_of_system(F.col("v")).alias("cpu"))


@query("SELECT i, CASE WHEN v IS NULL THEN NULL WHEN regexp_matches(lower(v), '" + "|".join(parsers.ENTERPRISE_GPU) + "') THEN 'enterprise' ELSE 'consumer' END AS segment FROM (SELECT i, v FROM " + FORMS + " UNION ALL SELECT 1000 + id, name FROM " + latest("gpus") + ")")
def x14_gpu_segment(spark, d):
    g = counting_rows(table(spark, d, "gpus"), "id", "updated_at", "name").select((F.col("id") + 1000).alias("i"), F.col("name").alias("v"))
    return _forms(spark).select(F.col("i").cast("bigint").alias("i"), "v").unionByName(g).select("i", parsers.gpu_segment(F.col("v")).alias("segment"))


def _os() -> str:
    version = "nullif(regexp_extract(v, '\\b(\\d{1,2}(?:\\.\\d+)?)\\b', 1), '')"
    named = " ".join(f"WHEN contains(lower(v), '{t}') THEN concat_ws(' ', '{label}', {version})" for t, label in parsers.OS_NAMES)
    return f"CASE WHEN v IS NULL OR v = '' THEN NULL {named} WHEN brand = 'apple' THEN 'iOS' WHEN brand <> '' THEN 'Android' END"


@query(f"SELECT i, {_os()} AS os FROM {FORMS}")
def x16_os(spark, d):
    return _forms(spark).select("i", parsers.os_name(F.col("v"), F.col("brand")).alias("os"))


_DESCRIBED = "\\b(black edition|extreme edition|(?:dual|two|quad|four|six|eight|ten|twelve|sixteen|\\d+)[- ]core)\\b"


@query(f"SELECT point_id, trim(regexp_replace(regexp_replace(regexp_replace(name, '\\s*\\([^)]*\\)', '', 'g'), '{_DESCRIBED}', '', 'gi'), '\\s+', ' ', 'g')) AS q FROM coverage_points WHERE category = 'cpu' UNION ALL SELECT -i, trim(regexp_replace(regexp_replace(regexp_replace(v, '\\s*\\([^)]*\\)', '', 'g'), '{_DESCRIBED}', '', 'gi'), '\\s+', ' ', 'g')) FROM {FORMS}")
def x04_search_text(spark, d):
    p = table(spark, d, "coverage_points").where("category = 'cpu'").select("point_id", F.col("name").alias("v")).unionByName(_forms(spark).select((-F.col("i")).cast("bigint").alias("point_id"), "v"))
    return p.select("point_id", parsers.search_text(F.col("v")).alias("q"))


PAGES = """(VALUES (1, 'Average CPU Mark 12,345 and Single Thread Rating: 2,987', 'Kore X1 @ 3.6GHz', 'Kore X1'), (2, 'Multithread Rating 900', 'Kore X2', 'Kore X2'), (3, 'single thread rating 10 multithread rating: 77', 'Kore X3D', 'Kore X3'), (4, NULL, 'A', NULL)) AS t(n, body, heading, asked)"""


@query(f"SELECT n, regexp_replace(regexp_replace(regexp_replace(heading, '\\s*@\\s*[\\d.]+\\s*ghz', '', 'gi'), '\\b(processor|cpu)\\b', '', 'gi'), '[^a-zA-Z0-9]+', '', 'g') = regexp_replace(asked, '[^a-zA-Z0-9]+', '', 'g') AS same, CASE WHEN regexp_matches(body, '(?:Multithread Rating|Average CPU Mark)[:\\s]*[\\d,]+', 'i') AND regexp_matches(body, 'Single Thread Rating[:\\s]*[\\d,]+', 'i') THEN replace(regexp_extract(body, '(?:Multithread Rating|Average CPU Mark)[:\\s]*([\\d,]+)', 1, 'i'), ',', '')::INT END AS mark, "
       f"CASE WHEN regexp_matches(body, '(?:Multithread Rating|Average CPU Mark)[:\\s]*[\\d,]+', 'i') AND regexp_matches(body, 'Single Thread Rating[:\\s]*[\\d,]+', 'i') THEN replace(regexp_extract(body, 'Single Thread Rating[:\\s]*([\\d,]+)', 1, 'i'), ',', '')::INT END AS single FROM {PAGES}")
def x18_page_marks(spark, d):
    """Whether a page is of the part asked for, and its two marks."""
    c = F.col
    return inline(spark, PAGES).select("n", parsers.same_part(c("heading"), c("asked")).alias("same"), parsers.page_marks(c("body")).alias("m")).select("n", "same", "m.mark", "m.single")


@query(f"SELECT i, try_cast(nullif(regexp_replace(v, '[^0-9]', '', 'g'), '') AS BIGINT) AS digits, try_cast(replace(nullif(regexp_extract(v, '\\d[\\d,]*\\.?\\d*', 0), ''), ',', '') AS DOUBLE) AS run FROM {FORMS}")
def x13_numbers(spark, d):
    return _forms(spark).select("i", parsers.digits_only(F.col("v")).alias("digits"), parsers.first_number(F.col("v")).alias("run"))


LABELS = "(VALUES (1, 'Cinebench 11.5 64-bit single-core'), (2, 'Cinebench 10 32-bit multi-core'), (3, 'Cinebench R15 multi'), (4, 'Cinebench 15 64-bit single-core'), (5, 'Passmark'), (6, 'Other single 20'), (7, NULL)) AS t(n, label)"


@query(f"SELECT n, CASE WHEN side IS NOT NULL THEN CASE WHEN contains(l, '11.5') THEN 'cinebench_r11_5_' || side WHEN regexp_matches(l, '\\br?10\\b') THEN 'cinebench_r10_' || side WHEN regexp_matches(l, '\\br?15\\b') THEN 'cinebench_r15_' || side END END AS field FROM (SELECT n, lower(label) AS l, CASE WHEN contains(lower(label), 'single') THEN 'single' WHEN contains(lower(label), 'multi') THEN 'multi' END AS side FROM {LABELS})")
def x06_benchmark_fields(spark, d):
    return inline(spark, LABELS).select("n", parsers.benchmark_field(F.col("label")).alias("field"))
