"""Queries of validation and of consistency signals, with SQL written from the rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.operators import validate, verify
from specloom.plans.catalog import latest, query
from specloom.sources.tables import counting_rows, table

# A small tree of documents of every category, most with faults; the SQL of both engines reads this text.
DOCS = """(VALUES
 ('brand/kr/saro.json', 'brand', '{"slug":"saro","name":"Saro","country":"KR","categories":["smartphone-oem","soc-designer"],"source_urls":["https://a.example/1"],"founded_year":1969}'),
 ('brand/us/volt.json', 'brand', '{"slug":"volt","name":"Volt","country":"US","categories":["cpu-designer","cpu-designer"],"source_urls":[],"founded_year":1700}'),
 ('brand/us/hale.json', 'brand', '{"slug":"hale","name":"Hale","country":"de","categories":["maker"],"source_urls":["ftp://x"]}'),
 ('brand/x/y/odd.json', 'brand', '{"slug":"Odd Slug","name":"Odd","country":null,"categories":[],"source_urls":"https://a.example"}'),
 ('brand/se/nil.json', 'brand', '{"slug":7,"name":"Nil","country":46,"categories":null,"source_urls":["http://a.example",5]}'),
 ('soc/saro/s1.json', 'soc', '{"slug":"s1","name":"S1","manufacturer":"saro","release_date":"2020-01-01","process_nm":7,"gpu_name":"G","source_urls":["https://a.example/s"]}'),
 ('soc/saro/s2.json', 'soc', '{"slug":"s1","name":"S2","manufacturer":"none","release_date":"2020","process_nm":"7","gpu_name":"G","source_urls":["https://a.example/s"]}'),
 ('soc/volt/s3.json', 'soc', '{"slug":"s3","name":"S3","manufacturer":"volt","release_date":null,"process_nm":0.5,"source_urls":["https://a.example/s"]}'),
 ('smartphone/saro/2021/p1/p1-8gb.json', 'smartphone', '{"slug":"p1-8gb","base_model_slug":"p1","name":"P1","brand":"saro","soc":"s1","release_date":"2021-02-03","ram_gb":8,"battery_mah":4000,"weight_g":180.5,"os":"A","msrp_usd":null,"source_urls":["https://a.example/p"]}'),
 ('smartphone/volt/2020/p2/p2.json', 'smartphone', '{"slug":"p2x","base_model_slug":"p3","name":"P2","brand":"saro","soc":"s9","release_date":"2021-02-03","ram_gb":true,"battery_mah":40000,"weight_g":"180","os":"A","msrp_usd":49,"source_urls":["https://a.example/p"]}'),
 ('smartphone/saro/2021/p4.json', 'smartphone', '{"slug":"p4","name":"P4","brand":"saro","release_date":"2021-99-99","ram_gb":8,"battery_mah":null,"weight_g":501,"os":"A","source_urls":["https://a.example/p"]}'),
 ('smartphone/p5.json', 'smartphone', '{"slug":"p5","name":"P5","brand":null,"soc":null,"release_date":null,"ram_gb":65,"battery_mah":500,"weight_g":50,"os":"A","source_urls":["https://a.example/p"]}'),
 ('tablet/saro/2021/t1.json', 'tablet', '{"slug":"t1","name":"T1","brand":"saro","soc":null,"release_date":"2021-01-01","ram_gb":0.01,"battery_mah":50,"weight_g":10,"os":"A","source_urls":["https://a.example/t"],"verified":false}'),
 ('watch/saro/2022/w1/w1.json', 'watch', '{"slug":"w1","name":"W1","brand":"saro","soc":"s8","release_date":"2022-01-01","ram_gb":0.5,"battery_mah":49,"weight_g":30,"os":"A","source_urls":["https://a.example/t"],"verified":false}'),
 ('pda/saro/None/d1/d1.json', 'pda', '{"slug":"d1","name":"D1","brand":"saro","release_date":null,"ram_gb":0.016,"battery_mah":900,"weight_g":100,"os":"A","source_urls":["https://a.example/t"]}'),
 ('gpu/volt/g1.json', 'gpu', '{"slug":"g1","name":"G1","manufacturer":"volt","architecture":"A","release_date":"2020-02-02","memory_gb":8,"memory_type":"G6","memory_bus_bit":128,"base_clock_mhz":1,"boost_clock_mhz":2,"tdp_w":3001,"pcie_version":"4.0","source_urls":["https://a.example/g"]}'),
 ('gpu/volt/g2.json', 'gpu', '{"slug":"g2","name":"G2","manufacturer":"Volt","release_date":"2020-02-02","memory_gb":0,"msrp_usd":[1],"source_urls":["https://a.example/g"]}'),
 ('cpu/volt/c1.json', 'cpu', '{"slug":"c1","name":"C1","manufacturer":"volt","release_date":"2020-02-02","segment":"desktop","architecture":"A","cores":8,"threads":16,"source_urls":["https://a.example/c"]}'),
 ('cpu/volt/c2.json', 'cpu', '{"slug":"c2","name":"C2","manufacturer":null,"release_date":"2020-2-2","segment":"tablet","architecture":"A","cores":0,"threads":1025,"msrp_usd":19.99}'),
 ('laptop/saro/2021/l1/l1.json', 'laptop', '{"slug":"l1","name":"L1","brand":"saro","cpu":"c1","gpu":null,"release_date":"2021-01-01","ram_gb":16,"storage_gb":0,"weight_g":299,"msrp_usd":50000,"os":"A","source_urls":["https://a.example/l"],"verified":true}'),
 ('laptop/saro/2021/l2.json', 'laptop', '{"slug":"l2","name":"L2","brand":"saro","cpu":"c7","gpu":"g7","release_date":"2021-01-01","ram_gb":257,"os":"A","source_urls":["https://a.example/l"],"verified":true}'),
 ('monitor/saro/2021/m1.json', 'monitor', '{"slug":"m1","name":"M1","brand":"nobody","release_date":"2021-01-01","size_inch":4.9,"resolution":"1x1","refresh_hz":1001,"ppi":19,"rating":5.1,"msrp_usd":9,"source_urls":["https://a.example/m"],"verified":true}'),
 ('game/e1.json', 'game', '{"slug":"e1","name":"E1","release_date":null,"rating":-1,"metacritic":101,"source_urls":["https://a.example/e"],"verified":true}'),
 ('game/e2.json', 'game', '{"slug":"e1","name":"E2","release_date":"soon","rating":null,"source_urls":["https://a.example/e"],"verified":true}'),
 ('software/f1.json', 'software', '{"slug":"f1","name":"F1","release_date":5,"source_urls":["https://a.example/f"]}'),
 ('website/h1.json', 'website', '{"slug":"-h1","name":"H1","launch_date":"1999","source_urls":["https://a.example/h"],"verified":true}')
) AS t(path, category, raw)"""

_ALL = f"(SELECT path, category, raw FROM {DOCS} UNION ALL SELECT output_path, category, record FROM ingest_candidates WHERE json_valid(record))"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    """The tree above and the drafts of the candidates, which lie at their output paths."""
    drafts = table(spark, d, "ingest_candidates").select(F.col("output_path").alias("path"), "category", F.col("record").alias("raw"))
    return spark.sql(f"SELECT * FROM {DOCS}").unionByName(drafts.where(F.try_parse_json("raw").isNotNull()))


def _own(spark: SparkSession, d: str, rule: str) -> DataFrame:
    """What one rule says; ``validate`` gives all of them at once."""
    return validate.documents(_docs(spark, d)).select("path", F.explode(validate.broken_rules()).alias("e")).where(F.col("e.rule") == rule).select("path", "e.field")


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _cases(table_: dict, of) -> str:
    return "CASE category " + " ".join(f"WHEN '{k}' THEN {of(v)}" for k, v in table_.items()) + " END"


_KIND = "coalesce(json_type(raw, '$.{f}'), 'MISSING')"
_STR = "CASE WHEN json_type(raw, '$.{f}') = 'VARCHAR' THEN raw ->> '$.{f}' END"


@query(f"SELECT path, field FROM (SELECT path, array_to_string(list_sort(list_filter({_cases(validate.REQUIRED, lambda v: f'[{_list(v)}]')}, lambda k: NOT list_contains(json_keys(raw), k))), ',') AS field FROM {_ALL}) WHERE field <> ''")
def v01_required_keys(spark, d):
    return _own(spark, d, "V01")


@query(f"SELECT path, 'slug' AS field FROM {_ALL} WHERE NOT coalesce(regexp_full_match({_STR.format(f='slug')}, '[a-z0-9]+(-[a-z0-9]+)*'), false)")
def v02_slug_rule(spark, d):
    return _own(spark, d, "V02")


def _v03() -> str:
    parts = []
    for c, fields in validate.RANGES.items():
        for f, (lo, hi) in fields.items():
            kind = _KIND.format(f=f)
            value = f"CASE WHEN {kind} IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT') THEN (raw ->> '$.{f}')::DOUBLE WHEN {kind} = 'BOOLEAN' THEN CASE WHEN raw ->> '$.{f}' = 'true' THEN 1 ELSE 0 END END"
            parts.append(f"SELECT path, '{f}' AS field FROM d WHERE category = '{c}' AND {kind} NOT IN ('MISSING', 'NULL') AND NOT coalesce({value} BETWEEN {lo} AND {hi}, false)")
    return f"WITH d AS {_ALL} " + " UNION ALL ".join(parts)


@query(_v03())
def v03_ranges(spark, d):
    return _own(spark, d, "V03")


_ISO = "coalesce(regexp_full_match({x}, '\\d{{4}}-\\d{{2}}-\\d{{2}}'), false)"


@query(
    f"WITH d AS {_ALL} SELECT path, 'release_date' AS field FROM d WHERE NOT {_ISO.format(x=_STR.format(f='release_date'))} AND ((category IN ({_list(validate.DATED)}) AND {_KIND.format(f='release_date')} <> 'MISSING') OR (category IN ({_list(validate.DATED_IF_KNOWN)}) AND {_KIND.format(f='release_date')} NOT IN ('MISSING', 'NULL'))) "
    f"UNION ALL SELECT path, 'launch_date' FROM d WHERE category = 'website' AND {_KIND.format(f='launch_date')} NOT IN ('MISSING', 'NULL') AND NOT {_ISO.format(x=_STR.format(f='launch_date'))}"
)
def v04_iso_dates(spark, d):
    return _own(spark, d, "V04")


@query(f"SELECT path, category, slug, min(path) OVER (PARTITION BY category, slug) AS first_path FROM (SELECT path, category, {_STR.format(f='slug')} AS slug FROM {_ALL}) WHERE slug IS NOT NULL QUALIFY row_number() OVER (PARTITION BY category, slug ORDER BY path) > 1")
def v05_duplicate_documents(spark, d):
    return validate.duplicate_slugs(_docs(spark, d)).select("path", "category", "slug", "first_path")


@query(
    f"SELECT path, 'source_urls' AS field FROM {_ALL} WHERE NOT coalesce(CASE WHEN json_type(raw, '$.source_urls') = 'ARRAY' THEN json_array_length(raw, '$.source_urls') > 0 AND len(list_filter(json_extract(raw, '$.source_urls[*]'), lambda u: json_type(u) = 'VARCHAR' AND regexp_matches(u ->> '$', '^https?://'))) = json_array_length(raw, '$.source_urls') END, false)"
)
def v06_source_urls(spark, d):
    return _own(spark, d, "V06")


def _v07() -> str:
    s = lambda f: _STR.format(f=f)
    deep = "p AS (SELECT *, string_split(path, '/') AS p FROM d WHERE category IN (" + _list(validate.FOLDERS) + ") AND NOT (category IN (" + _list(validate.FLAT) + ") AND len(string_split(path, '/')) = 4)), q AS (SELECT * FROM p WHERE len(p) = 5)"
    year = f"CASE WHEN {_KIND.format(f='release_date')} = 'NULL' THEN 'None' ELSE left(coalesce(raw ->> '$.release_date', ''), 4) END"
    return (
        f"WITH d AS {_ALL}, {deep} SELECT path, 'path' AS field FROM p WHERE len(p) <> 5 UNION ALL SELECT path, 'brand' FROM q WHERE ({s('brand')}) IS DISTINCT FROM p[2] UNION ALL SELECT path, 'release_date' FROM q WHERE {year} <> '' AND {year} <> p[3] "
        f"UNION ALL SELECT path, 'base_model_slug' FROM q WHERE coalesce({s('base_model_slug')}, '') NOT IN ('', p[4]) UNION ALL SELECT path, 'slug' FROM q WHERE p[5] IS DISTINCT FROM ({s('slug')}) || '.json'"
    )


@query(_v07())
def v07_variant_paths(spark, d):
    return _own(spark, d, "V07")


@query(f"SELECT path, 'country' AS field FROM {_ALL} WHERE category = 'brand' AND {_KIND.format(f='country')} NOT IN ('MISSING', 'NULL') AND NOT coalesce(regexp_full_match({_STR.format(f='country')}, '[A-Z]{{2}}'), false)")
def v08_countries(spark, d):
    return _own(spark, d, "V08")


@query(
    f"WITH b AS (SELECT path, CASE WHEN json_type(raw, '$.categories') = 'ARRAY' THEN CAST(json_extract_string(raw, '$.categories[*]') AS VARCHAR[]) ELSE [] END AS c FROM {_ALL} WHERE category = 'brand') SELECT path, 'categories' AS field FROM b WHERE len(c) = 0 "
    f"UNION ALL SELECT path, 'categories:allowed' FROM b WHERE len(list_filter(c, lambda x: x NOT IN ({_list(validate.BRAND_CATEGORIES)}))) > 0 UNION ALL SELECT path, 'categories:twice' FROM b WHERE len(c) > 0 AND len(list_distinct(c)) <> len(c)"
)
def v09_brand_categories(spark, d):
    return _own(spark, d, "V09")


@query(f"SELECT path, 'path' AS field FROM {_ALL} WHERE category = 'brand' AND (len(string_split(path, '/')) <> 3 OR coalesce(split_part(path, '/', 2) <> lower({_STR.format(f='country')}), false))")
def v10_brand_paths(spark, d):
    return _own(spark, d, "V10")


def _v11() -> str:
    parts = []
    for c, f, t, null_ok in validate.REFERENCES:
        skip = f" AND {_KIND.format(f=f)} NOT IN ('MISSING', 'NULL')" if null_ok else ""
        parts.append(f"SELECT path, '{f}' AS field FROM d WHERE category = '{c}'{skip} AND NOT EXISTS (SELECT 1 FROM s WHERE s.category = '{t}' AND s.slug = ({_STR.format(f=f)}))")
    known = f"s AS (SELECT category, {_STR.format(f='slug')} AS slug FROM d UNION ALL SELECT 'brand', slug FROM brands UNION ALL SELECT 'soc', slug FROM socs)"
    return f"WITH d AS {_ALL}, {known} " + " UNION ALL ".join(parts)


@query(_v11())
def v11_references(spark, d):
    known = table(spark, d, "brands").select(F.lit("brand").alias("category"), "slug").union(table(spark, d, "socs").select(F.lit("soc"), "slug"))
    return validate.missing_references(_docs(spark, d), known).select("path", "field")


@query(f"SELECT path, 'segment' AS field FROM {_ALL} WHERE category = 'cpu' AND NOT coalesce(({_STR.format(f='segment')}) IN ({_list(validate.SEGMENTS)}), false)")
def v12_segments(spark, d):
    return _own(spark, d, "V12")


# ---- Signals ------------------------------------------------------------------------

# Parts with the fields that the tables lack.
CPUS = "(VALUES (1, 65, 125, 1500, 22000, 1400, 9000, 8, 8, 16), (2, 125, 65, 2000, 1900, NULL, 9000, 8, 4, 12), (3, NULL, 125, 1000, NULL, 2100, 2000, NULL, 4, 4), (4, 65, 65, 1000, 1000, 1000, 1000, 2, 2, 5), (5, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL)) AS t(id, tdp_w, max_tdp_w, cinebench_r23_single, cinebench_r23_multi, geekbench_single, geekbench_multi, p_cores, e_cores, cores)"
GPUS = "(VALUES (1, 'nvidia', 8704, NULL, 68, DATE '2020-09-17'), (2, 'NVIDIA', NULL, 4096, NULL, DATE '2016-01-01'), (3, 'amd', NULL, 4096, 10, DATE '2017-08-14'), (4, 'intel', 128, NULL, 0, DATE '2015-01-01'), (5, 'other', NULL, 512, 1, NULL), (6, 'other', NULL, NULL, NULL, DATE '1999-01-01'), (7, NULL, 16, NULL, 2, DATE '2018-01-01'), (8, 'amd', 16, 32, NULL, NULL)) AS t(id, manufacturer, cuda_cores, stream_processors, rt_cores, release_date)"
NOW_YEAR = 2026


def _sig(ok: str) -> str:
    return f"CASE WHEN ({ok}) IS NULL THEN 'na' WHEN {ok} THEN 'pass' ELSE 'fail' END"


def _long(source: str, rules: dict[str, str], key: str = "id") -> str:
    return " UNION ALL ".join(f"SELECT {key} AS id, '{n}' AS signal, {_sig(ok)} AS result FROM {source}" for n, ok in rules.items())


_CPU_SQL = {"threads_ge_cores": "threads >= cores", "boost_ge_base": "boost_clock_ghz >= base_clock_ghz", "release_not_future": f"year(release_date) <= {NOW_YEAR + 1}"}


@query(_long(latest("cpus"), _CPU_SQL))
def g01_cpu_signals(spark, d):
    rows = counting_rows(table(spark, d, "cpus"), "id", "updated_at", "threads", "cores", "boost_clock_ghz", "base_clock_ghz", "release_date")
    return verify.long_signals(rows, verify.cpu_signals(NOW_YEAR), "id")


@query(_long(CPUS, {"max_tdp_ge_tdp": "max_tdp_w >= tdp_w", "cb23_multi_ge_single": "cinebench_r23_multi >= cinebench_r23_single", "gb_multi_ge_single": "geekbench_multi >= geekbench_single", "hybrid_core_sum": "p_cores + e_cores = cores"}))
def g03_part_signals(spark, d):
    return verify.long_signals(spark.sql(f"SELECT * FROM {CPUS}"), verify.cpu_signals(NOW_YEAR), "id")


@query(_long(latest("gpus"), {"boost_ge_base": "boost_clock_mhz >= base_clock_mhz", "release_not_future": f"year(release_date) <= {NOW_YEAR + 1}"}))
def g02_gpu_signals(spark, d):
    rows = counting_rows(table(spark, d, "gpus"), "id", "updated_at", "boost_clock_mhz", "base_clock_mhz", "release_date")
    return verify.long_signals(rows, verify.gpu_signals(NOW_YEAR), "id")


@query(
    f"SELECT id, 'release_not_future' AS signal, {_sig(f'year(release_date) <= {NOW_YEAR + 1}')} AS result FROM {GPUS} UNION ALL SELECT id, 'vendor_core_field', CASE WHEN lower(manufacturer) = 'nvidia' THEN CASE WHEN cuda_cores IS NOT NULL THEN 'pass' WHEN stream_processors IS NOT NULL THEN 'fail' ELSE 'na' END "
    f"WHEN lower(manufacturer) IN ('amd', 'intel') THEN CASE WHEN stream_processors IS NOT NULL THEN 'pass' WHEN cuda_cores IS NOT NULL THEN 'fail' ELSE 'na' END WHEN coalesce(cuda_cores, stream_processors) IS NOT NULL THEN 'pass' ELSE 'na' END FROM {GPUS} "
    f"UNION ALL SELECT id, 'rt_cores_era', CASE WHEN rt_cores > 0 AND release_date IS NOT NULL THEN CASE WHEN year(release_date) >= 2018 THEN 'pass' ELSE 'fail' END ELSE 'na' END FROM {GPUS}"
)
def g07_graphics_signals(spark, d):
    return verify.long_signals(spark.sql(f"SELECT * FROM {GPUS}"), verify.gpu_signals(NOW_YEAR), "id")


_SHAPE = "'(\\d{2,5})\\s*[x×]\\s*(\\d{2,5})'"
_W, _H = (f"try_cast(nullif(regexp_extract(display.resolution, {_SHAPE}, {g}), '') AS DOUBLE)" for g in (1, 2))
_MAJOR = "try_cast(nullif(regexp_extract(lower(os), 'android\\s*(\\d{1,2})', 1), '') AS INT)"
_S = "storage_options_gb"
_PHONE_SQL = {
    "ppi_consistent": f"CASE WHEN display.size_inch > 0 THEN abs(sqrt({_W} * {_W} + {_H} * {_H}) / display.size_inch - display.ppi) <= 0.15::DOUBLE * display.ppi END",
    "storage_sane": f"CASE WHEN len({_S}) > 0 THEN coalesce(list_min({_S}) >= 1 AND {_S} = list_sort(list_distinct({_S})), false) END",
    "os_era": f"year(release_date) >= CASE {_MAJOR} " + " ".join(f"WHEN {v} THEN {y}" for v, y in verify.ANDROID_YEARS.items()) + " END",
    "release_not_future": f"year(release_date) <= {NOW_YEAR + 1}",
    "ram_le_storage": f"ram_gb <= list_max({_S})",
    "soc_not_after_device": "year(soc_date) <= year(release_date) + CASE WHEN strftime(soc_date, '%m-%d') = '01-01' THEN 2 ELSE 0 END",
}


@query("WITH p AS (SELECT p.*, s.release_date AS soc_date FROM " + latest("smartphones") + " p LEFT JOIN " + latest("socs") + " s ON p.soc_id = s.id) " + _long("p", _PHONE_SQL))
def g09_phone_signals(spark, d):
    p = counting_rows(table(spark, d, "smartphones"), "id", "updated_at", "soc_id", "release_date", "ram_gb", "storage_options_gb", "display", "os")
    s = counting_rows(table(spark, d, "socs"), "id", "updated_at", "release_date").select(F.col("id").alias("soc_id"), F.col("release_date").alias("soc_date"))
    named = dict(zip(_PHONE_SQL, (x for x, _ in verify.phone_signals(NOW_YEAR))))
    return verify.long_signals(p.join(s, "soc_id", "left"), {n: (x, n == "release_not_future") for n, x in named.items()}, "id")


@query(_long(latest("socs"), {"release_not_future": f"year(release_date) <= {NOW_YEAR + 1}", "process_nm_era": "NOT ((process_nm < 7 AND year(release_date) < 2017) OR (process_nm < 3 AND year(release_date) < 2022))", "gpu_name_present": "coalesce(trim(gpu_name) <> '', false)"}))
def g14_soc_signals(spark, d):
    rows = counting_rows(table(spark, d, "socs"), "id", "updated_at", "release_date", "process_nm", "gpu_name")
    return verify.long_signals(rows, verify.soc_signals(NOW_YEAR), "id")


@query(_long(latest("brands"), {"founded_not_future": f"founded_year <= {NOW_YEAR}"}))
def g16_brand_signals(spark, d):
    return verify.long_signals(counting_rows(table(spark, d, "brands"), "id", "updated_at", "founded_year"), {"founded_not_future": (F.col("founded_year") <= NOW_YEAR, False)}, "id")
