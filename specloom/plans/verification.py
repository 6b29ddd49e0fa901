"""Queries of verification: sources, liveness, cross references, promotion, the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions import parsers
from specloom.operators import ledger, verify
from specloom.plans.catalog import latest, phones, query, rnd
from specloom.plans.reads import inline
from specloom.sources.tables import table

# Small tables of what the catalog's tables lack; both engines read this text. ``urls`` are parted by blanks.
RECORDS = """(VALUES
 (1, 'cpu/a.json', 'cpu', 'core-x1', 'Acme Core X1', false, 88.5, 'green', 'https://www.intel.com/x1 https://kaggle.com/d/', 2020),
 (2, 'cpu/b.json', 'cpu', 'core-x2', 'Core X2', true, 91.0, 'green', 'https://en.wikipedia.org/X2', 2021),
 (3, 'cpu/c.json', 'cpu', 'core-x3', 'Core X3', false, 88.5, 'yellow', 'https://KAGGLE.com/d https://gsmarena.com/x3?id=1', 2019),
 (4, 'gpu/d.json', 'gpu', 'card-1', 'Card 1', false, 40.0, 'red', 'https://dead.example/deep/page', 2018),
 (5, 'gpu/e.json', 'gpu', '', 'Card 2', false, 70.0, 'yellow', '', 2018),
 (6, 'gpu/f.json', 'gpu', 'card-3', 'Card 3', false, 77.0, 'green', 'https://gsmarena.com/c3', NULL),
 (7, 'soc/g.json', 'soc', 'chip-1', 'Chip 1', false, 61.0, 'yellow', 'https://slow.example/p https://techpowerup.com/p', 2022),
 (8, 'soc/h.json', 'soc', 'chip-2', ' ', false, 60.0, 'yellow', NULL, 2022)
) AS t(n, path, category, slug, name, verified, score, band, urls, year)"""
CACHE = """(VALUES
 (1, 'https://www.intel.com/x1', 200, 'https://www.intel.com/x1', true, 'http-200', '2026-05-30T10:00:00Z'),
 (2, 'https://kaggle.com/d/', 404, NULL, false, 'http-404', '2026-05-01T00:00:00Z'),
 (3, 'https://en.wikipedia.org/X2', 200, NULL, true, 'http-200', '2026-01-01T00:00:00Z'),
 (4, 'https://dead.example/deep/page', 200, 'https://dead.example/', false, 'homepage-redirect', '2026-05-31T23:59:59Z'),
 (5, 'https://gsmarena.com/c3', 429, NULL, false, 'http-429', '2026-05-31T00:00:00Z'),
 (6, 'https://gsmarena.com/x3?id=1', 503, NULL, false, 'http-503', '2026-05-31T00:00:00Z'),
 (7, 'https://slow.example/p', NULL, NULL, false, 'error', 'yesterday'),
 (8, 'https://techpowerup.com/p', 500, NULL, false, 'http-500', '2026-05-02T00:00:00Z'),
 (9, 'https://techpowerup.com/p', 200, NULL, true, 'http-200', '2026-05-03T00:00:00Z')
) AS t(line_no, url, status, final_url, alive, reason, checked_at)"""
FOUND = """(VALUES
 (1, 0, 'Core X1', CAST(NULL AS INT)), (1, 1, 'core-x1', 2021), (2, 0, 'Other', 2021), (2, 1, 'Xy', 2020), (3, 0, 'Core X3', 2015), (4, 0, 'Card 1', NULL), (6, 0, 'CARD 3', 2018), (7, 0, 'ip 1', 2022), (7, 1, 'The Chip 1', 2023), (8, 0, '', 2022)
) AS t(n, rank, title, year)"""
DECISIONS = "(VALUES ('cpu', 'core-x1', 'confirm'), ('cpu', 'core-x3', 'contradict'), ('gpu', 'card-3', 'ambiguous'), ('soc', 'chip-1', 'notfound')) AS t(category, slug, decision)"
NOW, DAYS = "2026-06-01T00:00:00Z", 30


def _records(spark: SparkSession) -> DataFrame:
    return inline(spark, RECORDS).withColumn("source_urls", F.split("urls", " "))


_LOADED = f"(SELECT url, arg_max(alive, line_no) AS alive, arg_max(reason, line_no) AS reason, arg_max(checked_at, line_no) AS checked_at FROM {CACHE} WHERE status IS NULL OR status NOT IN (429, 503) GROUP BY url)"
_URLS = f"(SELECT n, path, unnest(string_split(urls, ' ')) AS url, generate_subscripts(string_split(urls, ' '), 1) AS pos FROM {RECORDS})"
_HOST = "regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)', 1), '^www\\.', '')"
_TIER = "CASE " + " ".join("WHEN regexp_matches(" + _HOST + ", '(^|\\.)(" + "|".join(x.replace(".", "\\.") for x in hosts) + f")$') THEN {t}" for t, hosts in verify.TIER_HOSTS.items()) + " ELSE 0 END"
_TARGETS = f"(SELECT arg_min(url, (n, pos)) AS url FROM {_URLS} GROUP BY lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', ''))"


@query(f"SELECT url, alive, reason FROM {_LOADED}")
def k11_cache(spark, d):
    return ledger.load_cache(inline(spark, CACHE)).select("url", "alive", "reason")


@query(f"SELECT url, status IN (429, 503) AS transient FROM {CACHE} WHERE status IS NOT NULL")
def f09_transient(spark, d):
    return inline(spark, CACHE).where("status is not null").select("url", F.col("status").isin(*ledger.TRANSIENT).alias("transient"))


@query(f"SELECT line_no, try_strptime(checked_at, '%Y-%m-%dT%H:%M:%SZ') AS at, coalesce(floor(epoch(TIMESTAMP '2026-06-01 00:00:00' - try_strptime(checked_at, '%Y-%m-%dT%H:%M:%SZ')) / 86400) < {DAYS}, false) AS fresh FROM {CACHE}")
def d04_instants(spark, d):
    c = inline(spark, CACHE).withColumn("t", ledger.instant(F.col("checked_at")))
    return c.select("line_no", F.col("t").cast("timestamp_ntz").alias("at"), verify.fresh(F.col("t"), ledger.instant(F.lit(NOW)), DAYS).alias("fresh"))


@query(f"SELECT r.n, count(*) FILTER (c.alive) AS live, count(*) FILTER (NOT c.alive) AS dead, coalesce(bool_or(c.alive AND ({_TIER.replace('url', 'u.url')}) IN (1, 2)), false) AS live_authoritative FROM {RECORDS.replace('AS t(', 'AS r(')} LEFT JOIN {_URLS} u ON r.n = u.n LEFT JOIN {_LOADED} c ON u.url = c.url GROUP BY 1")
def j15_liveness(spark, d):
    """A21 is its last column."""
    return ledger.liveness(_records(spark), inline(spark, CACHE), "n")


@query(f"SELECT url FROM {_TARGETS} WHERE url NOT IN (SELECT url FROM {_LOADED} WHERE coalesce(floor(epoch(TIMESTAMP '2026-06-01 00:00:00' - try_strptime(checked_at, '%Y-%m-%dT%H:%M:%SZ')) / 86400) < {DAYS}, false))")
def j19_to_check(spark, d):
    return ledger.to_check(ledger.distinct_urls(_records(spark), "n"), inline(spark, CACHE), NOW, DAYS)


@query(f"SELECT count(*) FILTER (alive) AS alive, count(*) FILTER (NOT alive) AS dead FROM {_TARGETS} JOIN {_LOADED} USING (url)")
def a19_liveness_summary(spark, d):
    return ledger.liveness_summary(ledger.distinct_urls(_records(spark), "n"), inline(spark, CACHE))


@query(f"SELECT reason, count(*) AS n FROM {_TARGETS} JOIN {_LOADED} USING (url) WHERE NOT alive GROUP BY 1 ORDER BY n DESC, reason LIMIT 10")
def a19_dead_reasons(spark, d):
    return ledger.dead_reasons(ledger.distinct_urls(_records(spark), "n"), inline(spark, CACHE))


@query(f"SELECT line_no, CASE WHEN status IS NULL THEN false WHEN status >= 400 THEN false WHEN final_url <> url AND len(list_filter(string_split(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/'), lambda p: p <> '')) >= 1 AND len(list_filter(string_split(regexp_extract(final_url, '://[^/?#]*([^?#]*)', 1), '/'), lambda p: p <> '')) = 0 THEN false ELSE true END AS alive, "
       f"CASE WHEN status IS NULL THEN 'error' WHEN status >= 400 THEN 'http-' || status WHEN final_url <> url AND len(list_filter(string_split(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/'), lambda p: p <> '')) >= 1 AND len(list_filter(string_split(regexp_extract(final_url, '://[^/?#]*([^?#]*)', 1), '/'), lambda p: p <> '')) = 0 THEN 'homepage-redirect' ELSE 'http-' || status END AS reason FROM {CACHE}")
def q17_classified(spark, d):
    c = F.col
    return inline(spark, CACHE).select("line_no", parsers.liveness(c("url"), c("status"), c("final_url")).alias("l")).select("line_no", "l.alive", "l.reason")


@query(f"SELECT candidate_id, len(list_filter(string_split(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/'), lambda p: p <> '')) AS depth FROM crossref_candidates")
def x12_path_depth(spark, d):
    return table(spark, d, "crossref_candidates").select("candidate_id", parsers.path_depth(F.col("url")).alias("depth"))


@query(f"SELECT url, {_TIER} AS tier FROM {CACHE} UNION ALL SELECT * FROM (SELECT DISTINCT url, {_TIER} AS tier FROM crossref_candidates)")
def x11_tiers(spark, d):
    urls = inline(spark, CACHE).select("url").unionByName(table(spark, d, "crossref_candidates").select("url").distinct())
    return urls.select("url", verify.host_tier(parsers.host_of(F.col("url"))).alias("tier"))


@query(f"SELECT n, coalesce(min(nullif(t, 0)), 0) AS best, count(DISTINCT h) FILTER (t IN (1, 2)) AS strong FROM (SELECT r.n, {_HOST} AS h, {_TIER} AS t FROM {RECORDS.replace('AS t(', 'AS r(')} LEFT JOIN {_URLS} u ON r.n = u.n) GROUP BY 1")
def a14_best_tiers(spark, d):
    """A14 and A15."""
    u = F.coalesce("source_urls", F.array().cast("array<string>"))
    return _records(spark).select("n", verify.best_tier(u).alias("best"), verify.strong_hosts(u).cast("bigint").alias("strong"))


@query(f"SELECT n, score FROM {RECORDS} WHERE NOT verified AND slug <> '' ORDER BY score DESC, n LIMIT 4")
def o07_frontier(spark, d):
    return ledger.frontier(_records(spark), "n", 4).select("n", "score")


@query(f"SELECT n, path FROM {RECORDS} WHERE category IN ('gpu', 'cpu') AND NOT verified AND path <> 'cpu/a.json' ORDER BY CASE category WHEN 'gpu' THEN 1 ELSE 2 END, n LIMIT 4")
def f06_selection(spark, d):
    r = _records(spark)
    return ledger.selected(r, ["gpu", "cpu"], "n", True, r.where("path <> 'cpu/a.json'"), 4).select("n", "path")


_N, _H = "regexp_replace(lower(r.name), '[^a-z0-9]+', '', 'g')", "regexp_replace(lower(c.title), '[^a-z0-9]+', '', 'g')"


@query(
    f"WITH m AS (SELECT r.n, {_N} <> '' AND {_H} <> '' AND ({_N} = {_H} OR (length({_H}) >= 4 AND (ends_with({_N}, {_H}) OR ends_with({_H}, {_N})))) AS near, c.rank, c.year FROM {RECORDS.replace('AS t(', 'AS r(')} JOIN {FOUND.replace('AS t(', 'AS c(')} ON r.n = c.n WHERE trim(r.name) <> ''), "
    "b AS (SELECT n, bool_or(near) AS near, arg_min({'y': year}, (year IS NULL, rank)) FILTER (near) AS best FROM m GROUP BY 1) "
    f"SELECT r.n, CASE WHEN b.n IS NULL THEN 'notfound' WHEN NOT b.near OR r.year IS NULL OR b.best.y IS NULL THEN 'ambiguous' WHEN abs(b.best.y - r.year) <= 1 THEN 'confirm' ELSE 'contradict' END AS decision FROM {RECORDS.replace('AS t(', 'AS r(')} LEFT JOIN b ON r.n = b.n"
)
def q18_crossref(spark, d):
    return verify.crossref(_records(spark), inline(spark, FOUND), "n")


_DECIDED = f"(SELECT r.*, d.decision, coalesce(d.decision = 'confirm' OR (d.decision IS DISTINCT FROM 'contradict' AND r.band = 'green'), false) AS promote, CASE WHEN d.decision = 'contradict' THEN 'crossref-contradict' WHEN d.decision = 'confirm' THEN 'crossref-confirm' WHEN r.band = 'green' THEN 'green' ELSE 'needs-confirmation' END AS reason FROM {RECORDS.replace('AS t(', 'AS r(')} LEFT JOIN {DECISIONS.replace('AS t(', 'AS d(')} ON r.category = d.category AND r.slug = d.slug)"


@query(f"SELECT n, decision, promote, reason FROM {_DECIDED}")
def j16_decided(spark, d):
    return ledger.decided(_records(spark), inline(spark, DECISIONS)).select("n", "decision", "promote", "reason")


@query(f"SELECT promote, reason, count(*) AS n FROM {_DECIDED} WHERE NOT verified AND slug <> '' GROUP BY 1, 2")
def a20_reasons(spark, d):
    return ledger.reason_counts(ledger.decided(_records(spark), inline(spark, DECISIONS)))


@query(
    f"WITH l AS (SELECT u.n, count(*) FILTER (c.alive) AS live, count(*) FILTER (NOT c.alive) AS dead FROM {_URLS} u LEFT JOIN {_LOADED} c ON u.url = c.url GROUP BY 1) "
    f"SELECT d.category, count(*) AS records, count(*) FILTER (d.band = 'green') AS green, count(*) FILTER (d.band = 'yellow') AS yellow, count(*) FILTER (d.band = 'red') AS red, coalesce(sum(l.live), 0)::BIGINT AS live, coalesce(sum(l.dead), 0)::BIGINT AS dead, count(*) FILTER (d.decision = 'contradict') AS contradicted, count(*) FILTER (d.promote) AS promotable FROM {_DECIDED} d LEFT JOIN l ON d.n = l.n WHERE d.path NOT IN ('cpu/b.json') GROUP BY 1"
)
def q21_changed_report(spark, d):
    """All tiers over the changed files (all but one)."""
    r = _records(spark)
    changed = r.join(r.where("path <> 'cpu/b.json'").select("path"), "path", "left_semi")
    rows = ledger.decided(changed, inline(spark, DECISIONS)).join(ledger.liveness(changed, inline(spark, CACHE), "n"), "n")
    is_ = lambda b: F.count_if(F.col("band") == b).alias(b)
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("records"), is_("green"), is_("yellow"), is_("red"), F.sum("live").alias("live"), F.sum("dead").alias("dead"), F.count_if(F.col("decision") == "contradict").alias("contradicted"), F.count_if("promote").alias("promotable"))


@query(f"SELECT id, CASE WHEN coalesce(base_model_slug, '') <> '' THEN 'smartphone/' || coalesce(brand_id::VARCHAR, '') || '/' || base_model_slug ELSE 'smartphone/' || coalesce(nullif(slug, ''), 'smartphone/' || id || '.json') END AS model FROM {latest('smartphones')}")
def p07_model_keys(spark, d):
    c = F.col
    return phones(spark, d, "slug", "brand_id", "base_model_slug").select("id", ledger.model_key(F.lit("smartphone"), c("brand_id").cast("string"), c("base_model_slug"), c("slug"), F.concat(F.lit("smartphone/"), c("id").cast("string"), F.lit(".json"))).alias("model"))


@query()
def p08_content_hash(spark, d):
    """No SQL: the canonical text is that of a JSON library."""
    return table(spark, d, "ingest_candidates").select("ingest_id", ledger.content_hash("record").alias("hash"))


@query(f"SELECT '{NOW}' AS ts, category, slug, path, 'h' || n AS hash, score::DOUBLE AS score, band FROM {RECORDS}")
def p09_ledger_entries(spark, d):
    r = _records(spark).withColumns({"hash": F.concat(F.lit("h"), F.col("n").cast("string")), "flags": F.array().cast("array<string>"), "best_tier": verify.best_tier(F.coalesce("source_urls", F.array().cast("array<string>"))), "score": F.col("score").cast("double")})
    return r.select(ledger.entry(NOW).alias("e")).select("e.ts", "e.category", "e.slug", "e.path", "e.hash", "e.tier0.score", "e.tier0.band")


@query("SELECT category, slug, max(ingest_id) AS ingest_id, arg_max(source_url, ingest_id) AS source_url FROM ingest_candidates WHERE category IS NOT NULL AND slug IS NOT NULL GROUP BY 1, 2")
def w03_ledger_latest(spark, d):
    """Later lines override earlier ones; candidates stand for a log, their id for the line."""
    return ledger.latest(table(spark, d, "ingest_candidates").select("category", "slug", "ingest_id", "source_url"), "ingest_id")


@query("SELECT ingest_id, coalesce(list_bool_or(list_transform(json_keys(record), lambda k: starts_with(k, 'base_'))), false) AS has FROM ingest_candidates WHERE json_valid(record)")
def c05_key_prefix(spark, d):
    """Whether a document has a key that begins like this (for provenance: raw_)."""
    i = table(spark, d, "ingest_candidates").where(F.try_parse_json("record").isNotNull())
    return i.select("ingest_id", verify.has_key_like(F.col("record"), "base_").alias("has"))


@query("SELECT n, raw, tier, " + rnd("CASE WHEN NOT raw THEN 7.0 WHEN tier IN (1, 2) THEN 8.0 ELSE 2.0 END") + " AS points FROM (VALUES (1, false, 0), (2, true, 1), (3, true, 2), (4, true, 3), (5, true, 0)) AS t(n, raw, tier)")
def q16_provenance(spark, d):
    return inline(spark, "(VALUES (1, false, 0), (2, true, 1), (3, true, 2), (4, true, 3), (5, true, 0)) AS t(n, raw, tier)").select("n", "raw", "tier", verify.provenance(F.col("raw"), F.col("tier")).alias("points"))
