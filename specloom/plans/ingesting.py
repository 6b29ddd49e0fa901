"""Queries of ingest, enrichment, coverage and integrity.

Pages are small texts in this module; what their readers must find is stated as rows, worked
out from the rules by hand. What follows the readers has SQL over tables.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.functions import parsers
from specloom.operators import ingest, records
from specloom.plans.catalog import latest, query
from specloom.plans.quality import DOCS
from specloom.plans.reads import inline
from specloom.session import shared_path
from specloom.sources import documents, html, sinks
from specloom.sources.tables import counting_rows, table

CPU_PAGE = """<h2>Ridge [1]</h2><h3>Tables edit</h3><table class="wikitable sortable"><tr><th>Model number</th><th>Cores / Threads</th><th>Base clock</th><th>Turbo</th><th>L3 cache</th><th>TDP</th><th>Release date</th><th>Socket</th></tr>
<tr><td>Intel Core X1-990K<sup>[a]</sup></td><td rowspan="2">8 / 16</td><td>3.6 GHz</td><td>4900 MHz</td><td>16 MB</td><td>65/95 W</td><td>April 5, 2023</td><td>S1</td></tr>
<tr><td>Xeon W-77</td><td>2.5 GHz</td><td></td><td>1 GB</td><td>205 W</td><td>Q3 2021</td><td>S2</td></tr><tr><td colspan="8">Notes 2</td></tr></table><table><tr><th>Model</th></tr><tr><td>X9-999</td></tr></table>
<table class="wikitable"><tr><th>Processor</th><th>Code name</th><th>Released</th></tr><tr><td>Atom Z-500</td><td>Silver</td><td></td></tr></table>"""
GPU_PAGE = """<h2>Turin</h2><table class="wikitable"><tr><th>Model</th><th>Launch</th><th>Memory</th><th>Memory type</th><th>Bus width</th><th>Base clock</th><th>Boost clock</th><th>TBP</th><th>PCIe</th></tr>
<tr><td>GeForce GX 1080</td><td>2016/05/27</td><td>8 GB</td><td>gddr5x</td><td>256-bit</td><td>1607 MHz</td><td>1.733 GHz</td><td>180 W</td><td>PCIe 3.0 x16</td></tr><tr><td>Quadro M2</td><td>2017</td><td>4096 MB</td><td></td><td></td><td></td><td></td><td></td><td></td></tr><tr><td>GX one</td><td></td><td></td><td></td><td></td><td></td><td></td><td></td><td></td></tr></table>"""
PHONE_PAGE = """<h2>List</h2><table class="wikitable"><tr><th>Name</th><th>Chipset</th><th>RAM</th><th>Battery</th><th>Weight</th><th>OS</th><th>Launched</th></tr>
<tr><td>Nova 5</td><td>Qualcomm Snap 8 Gen 3 for Orbit</td><td>8 GB or 12 GB</td><td>5,000 mAh</td><td>203 g</td><td>Android 14</td><td>9 May 2024</td></tr><tr><td>OnePlus Mini</td><td>Unknown</td><td>512 MB</td><td>20 mAh</td><td></td><td>(tba)</td><td>2019</td></tr><tr><td>X</td><td></td><td></td><td></td><td></td><td></td><td></td></tr></table>"""
SCORE_PAGES = {
    "duo": """<table><tr><th>CPU Name</th><th>Cores</th><th>Single Core</th><th>Multi Core</th></tr><tr><td>Kore X1 @ 3.6GHz</td><td>8</td><td>1,900 pts</td><td>20,000</td></tr><tr><td>Kore X2</td><td>8</td><td>-</td><td>900</td></tr><tr><td>KORE X1</td><td>8</td><td>1901</td><td>20001</td></tr></table><table><tr><td>Name</td><td>single</td></tr><tr><td>Kore X9</td><td>5</td></tr><tr><td>a</td><td>b</td></tr></table>""",
    "wide": """<table><tr><th>Pos</th><th>Model</th><th>Cinebench R15 CPU Single 64Bit</th><th>Cinebench R23 Multi Core</th><th>Geekbench 6.6 Single-Core</th><th>Geekbench 5.5 Multi</th></tr><tr><td>1</td><td>Kore X1</td><td>310.6</td><td>20,300</td><td>2900</td><td>9</td></tr><tr><td>2</td><td>Kore X1 Processor</td><td>1</td><td>2</td><td>3</td><td>4</td></tr><tr><td>3</td><td>Kore X2</td><td>0</td><td></td><td>n/a</td><td>7</td></tr><tr><td>4</td><td>Kore X3</td><td></td><td>99.5</td><td></td><td></td></tr></table>""",
    "system": "<table><tr><th>Sponsor</th></tr>" + "".join(f"<tr><td>s</td><td>{n}</td>" + "<td>x</td>" * 5 + f"<td>{v}</td><td>p</td></tr>" for n, v in (("Rack (Kore X1, 2.30 GHz)", "55.5"), ("Box (old) (Kore X1)", "61.25"), ("Tray (Kore X2)", "0"), ("Tray Kore X3", "9"), ("Tray (Kore X3)", "NC"))) + "<tr><td>a</td><td>(Kore X4)</td></tr></table>",
    "tabs": """<h1>Kore X1: specs</h1><div class="tab"><h4>Cinebench 11.5 64-bit single-core</h4><div class="item"><strong>X1</strong><em class="avarage">1.98</em></div><div class="item"><em class="avarage">9</em></div></div><div class="tab"><h4>Cinebench R15 multi-core</h4><div class="item"><em class="avarage">1,620.7</em></div></div><div class="tab"><h4>Other</h4><div class="item"><em class="avarage">5</em></div></div><div class="tab"><h4>Cinebench 15 multi</h4><em class="avarage">1</em></div>""",
    "rank": """<div><input data-cmp="1" value="GeForce GX 1080"><span class="x font-bold">18,250</span></div><div><input data-cmp="2" value="GX 1080/PCIe/SSE2"><span class="font-bold">7</span></div><div><input data-cmp="3" value="Radeon RZ 580 8GB"><p><span class="font-bold">6.2 TF</span></p></div><div><input data-cmp="4" value="RZ 1"><span>9</span></div><input value="no">""",
    "list": """<table><tr id="gpu1"><td><a>GeForce GX 1080</a></td><td>15,300</td><td>1</td></tr><tr id="gpu2"><td>GX 1080</td><td>1</td></tr><tr id="cpu3"><td>RZ 580</td><td>2</td></tr><tr id="gpu4"><td>RZ 580</td><td>-</td></tr><tr id="gpu5"><td>RZ 9</td><td>88</td></tr></table>""",
    "part": """<h2>Other</h2><span class="cpuname">Kore X1 @ 3.60GHz</span><div>Average CPU Mark</div><b>12,345</b><p>Single Thread Rating: 2,987</p>""",
    "lookup": """<a href="/cpu.php?cpu=Kore+X2&id=41"><span class="prdname">Kore X2 Pro</span></a><a href="/cpu.php?id=42&x=1"><span class="prdname">Kore X2 @ 2GHz</span></a><a href="/cpu.php?id=43"><span class="prdname">KORE X2</span></a><span class="prdname">Kore X2</span>""",
}


def _pages(spark: SparkSession, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), "manufacturer string, title string, html string, fallback string")


def _score_page(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([(f"https://s.example/{name}", SCORE_PAGES[name])], "url string, html string")


def _rows(columns: str, *rows: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS t({columns})"


# ---- Readers ------------------------------------------------------------------------


@query(_rows("row_no, field, value", "(0, 'model', 'Intel Core X1-990K [a]')", "(0, 'cores', '8 / 16')", "(0, 'base_clock', '3.6 GHz')", "(0, 'boost_clock', '4900 MHz')", "(0, 'l3_cache', '16 MB')", "(0, 'tdp', '65/95 W')", "(0, 'release_date', 'April 5, 2023')", "(0, 'socket', 'S1')",
             "(1, 'model', 'Xeon W-77')", "(1, 'cores', '8 / 16')", "(1, 'base_clock', '2.5 GHz')", "(1, 'l3_cache', '1 GB')", "(1, 'tdp', '205 W')", "(1, 'release_date', 'Q3 2021')", "(1, 'socket', 'S2')",
             *[f"(2, '{f}', 'Notes 2')" for f in ("model", "cores", "base_clock", "boost_clock", "l3_cache", "tdp", "release_date", "socket")], "(3, 'model', 'Atom Z-500')"))
def s12_field_rows(spark, d):
    """Spans filled in, headers by rules ("Code name" is a name to the first of them), blank cells left out."""
    found = html.page_fields(_pages(spark, ("intel", "P", CPU_PAGE, None)), ingest.HEADERS["cpu"], ("title",))
    return found.select("row_no", F.explode("cells").alias("field", "value"))


@query(_rows("row_no, text", "(0, 'Intel Core X1-990K')", "(1, 'Xeon W-77')", "(2, 'Notes 2')", "(3, 'Atom Z-500')"))
def s13_first_cells(spark, d):
    return html.page_first_cells(_pages(spark, ("intel", "P", CPU_PAGE, None), ("intel", "Q", None, None)), ("title",)).select("row_no", "text")


_WIKI = "https://en.wikipedia.org/wiki/"


@query(_rows("category, slug, name, source", "('cpu', 'core-x1-990k', 'Intel Core X1-990K', 'wikipedia:P')", "('cpu', 'xeon-w-77', 'Xeon W-77', 'wikipedia:P')", "('cpu', 'notes-2', 'Notes 2', 'wikipedia:P')", "('cpu', 'atom-z-500', 'Atom Z-500', 'wikipedia:P')", "('gpu', 'geforce-gx-1080', 'GeForce GX 1080', 'wikipedia:G')", "('gpu', 'quadro-m2', 'Quadro M2', 'wikipedia:G')", "('smartphone', 'nova-5', 'Nova 5', 'wikipedia:H')", "('smartphone', 'mini', 'OnePlus Mini', 'wikipedia:H')"))
def s14_coverage_points(spark, d):
    """S14, S15 and S16."""
    parts = [ingest.coverage_points(_pages(spark, (maker, title, page, None)), c) for c, maker, title, page in (("cpu", "intel", "P", CPU_PAGE), ("gpu", "nvidia", "G", GPU_PAGE), ("smartphone", "oneplus", "H", PHONE_PAGE))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("category", "slug", "name", "source")


@query(
    _rows(
        "slug, name, segment, architecture, cores, threads, base_clock_ghz, boost_clock_ghz, l3_cache_mb, tdp_w, release_date, missing, output_path",
        "('core-x1-990k-a', 'Intel Core X1-990K [a]', 'desktop', 'Ridge', 8, 16, 3.6::DOUBLE, 4.9::DOUBLE, 16.0::DOUBLE, 65, DATE '2023-04-05', '', 'cpu/intel/2023/consumer/core-x1-990k-a.json')",
        "('xeon-w-77', 'Intel Xeon W-77', 'server', 'Ridge', 8, 16, 2.5, NULL, 1024.0, 205, DATE '2021-07-01', '', 'cpu/intel/2021/enterprise/xeon-w-77.json')",
        "('notes-2', 'Intel Notes 2', 'desktop', 'Ridge', 2, 2, NULL, NULL, NULL, NULL, NULL, 'release_date', 'cpu/intel/unknown/consumer/notes-2.json')",
        "('atom-z-500', 'Intel Atom Z-500', 'desktop', 'Ridge', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'release_date,cores,threads', 'cpu/intel/unknown/consumer/atom-z-500.json')",
    )
)
def s17_cpu_drafts(spark, d):
    """S17, S20, P03, P04, P06 of processors."""
    rows = ingest.drafts(_pages(spark, ("intel", "P", CPU_PAGE, "Fallback")), "cpu")
    return rows.select("slug", "name", "segment", "architecture", "cores", "threads", "base_clock_ghz", "boost_clock_ghz", "l3_cache_mb", "tdp_w", "release_date", F.array_join("missing_fields", ",").alias("missing"), "output_path")


@query(
    _rows(
        "slug, name, segment, memory_gb, memory_type, memory_bus_bit, base_clock_mhz, boost_clock_mhz, tdp_w, pcie_version, missing, output_path",
        "('geforce-gx-1080', 'NVIDIA GeForce GX 1080', 'consumer', 8.0::DOUBLE, 'GDDR5X', 256, 1607, 1733, 180, '3.0', '', 'gpu/nvidia/2016/consumer/geforce-gx-1080.json')",
        "('quadro-m2', 'NVIDIA Quadro M2', 'enterprise', 4.0, NULL, NULL, NULL, NULL, NULL, NULL, 'memory_type,memory_bus_bit,base_clock_mhz,boost_clock_mhz,tdp_w,pcie_version', 'gpu/nvidia/2017/enterprise/quadro-m2.json')",
    )
)
def s18_gpu_drafts(spark, d):
    """The column "Memory type" is read as memory, the first rule that fits: its own first column stays."""
    page = GPU_PAGE.replace("<th>Memory type</th>", "<th>Type</th>")
    rows = ingest.drafts(_pages(spark, ("nvidia", "G", page, None)), "gpu")
    return rows.select("slug", "name", "segment", "memory_gb", "memory_type", "memory_bus_bit", "base_clock_mhz", "boost_clock_mhz", "tdp_w", "pcie_version", F.array_join("missing_fields", ",").alias("missing"), "output_path")


@query(
    _rows(
        "manufacturer, slug, name, soc, ram_gb, battery_mah, weight_g, os, missing, output_path",
        "('oneplus', 'nova-5', 'OnePlus Nova 5', 'snap-8-gen-3', 12, 5000, 203, 'Android 14', '', 'smartphone/oneplus/nova-5.json')",
        "('oneplus', 'mini', 'OnePlus Mini', NULL, NULL, NULL, NULL, 'Android', 'soc,ram_gb,battery_mah,weight_g', 'smartphone/oneplus/mini.json')",
    )
)
def s19_phone_drafts(spark, d):
    """Brands that are not curated are left out, chips that are not known are null."""
    pages = _pages(spark, ("oneplus", "H", PHONE_PAGE, None), ("nobody", "H", PHONE_PAGE, None))
    rows = ingest.drafts(pages, "smartphone", inline(spark, "(VALUES ('snap-8-gen-3'), ('snap-8-gen-3')) AS t(slug)"), inline(spark, "(VALUES ('oneplus')) AS t(slug)"))
    return rows.select("manufacturer", "slug", "name", "soc", "ram_gb", "battery_mah", "weight_g", "os", F.array_join("missing_fields", ",").alias("missing"), "output_path")


def _scores(df: DataFrame) -> DataFrame:
    return df.select("key", F.explode("scores").alias("field", "value"))


@query(_rows("key, field, value", "('korex1', 'cinebench_r23_single', 1901.0::DOUBLE)", "('korex1', 'cinebench_r23_multi', 20001.0)"))
def s21_last_wins(spark, d):
    return _scores(ingest.score_table(_score_page(spark, "duo"), lambda p: html.name_single_multi(p, "cinebench_r23"), parsers.cpu_key, "last"))


@query(_rows("key, field, value", "('korex1', 'cinebench_r15_single', 311.0::DOUBLE)", "('korex1', 'cinebench_r23_multi', 20300.0)", "('korex1', 'geekbench_single', 2900.0)", "('korex3', 'cinebench_r23_multi', 100.0)"))
def s22_wide_first_wins(spark, d):
    return _scores(ingest.score_table(_score_page(spark, "wide"), html.wide_benchmarks, parsers.cpu_key))


@query(_rows("key, field, value", "('korex1', 'specint2006', 61.25::DOUBLE)"))
def s23_greatest_wins(spark, d):
    return _scores(ingest.score_table(_score_page(spark, "system"), lambda p: html.system_results(p, "specint2006"), parsers.cpu_key, "max"))


def _label_field(label: str) -> str | None:
    """As parsers.benchmark_field, for one text."""
    import re

    low = label.lower()
    side = "single" if "single" in low else "multi" if "multi" in low else None
    version = "r11_5" if "11.5" in low else "r10" if re.search(r"\br?10\b", low) else "r15" if re.search(r"\br?15\b", low) else None
    return f"cinebench_{version}_{side}" if side and version else None


@query(_rows("key, field, value", "('korex1', 'cinebench_r11_5_single', 1.98::DOUBLE)", "('korex1', 'cinebench_r15_multi', 1620.0)"))
def s24_part_tabs(spark, d):
    return _scores(ingest.score_table(_score_page(spark, "tabs"), lambda p: html.tabbed_page(p, _label_field), parsers.cpu_key))


@query(_rows("key, field, value", "('gx1080', 'timespy_score', 18250.0::DOUBLE)", "('rz580', 'timespy_score', 62.0)"))
def s25_ranking(spark, d):
    return _scores(ingest.score_table(_score_page(spark, "rank"), lambda p: html.ranking(p, "timespy_score"), parsers.gpu_key))


@query(_rows("key, field, value", "('gx1080', 'passmark_g3d_mark', 15300.0::DOUBLE)", "('rz9', 'passmark_g3d_mark', 88.0)"))
def s26_listed_cards(spark, d):
    return _scores(ingest.score_table(_score_page(spark, "list"), lambda p: html.listed_parts(p, "passmark_g3d_mark"), parsers.gpu_key))


@query(_rows("asked, mark, single, how", "('Kore X1', 12345, 2987, 'direct')", "('Kore X2', 12345, 2987, 'resolved')", "('Kore X5', 12345, 2987, 'override')"))
def s27_part_pages(spark, d):
    """An override decides alone; else the page searched for, if it is of the part; else the looked-up one."""
    page = SCORE_PAGES["part"]
    of = lambda *rows: spark.createDataFrame([(a, f"https://p.example/{a}", h) for a, h in rows], "asked string, url string, html string")
    direct = ingest.page_results(of(("Kore X1", page), ("Kore X2", page), ("Kore X3", "<h1>x</h1>"), ("Kore X6", page.replace("Kore X1", "Kore X6"))))
    ids = ingest.looked_up_ids(spark.createDataFrame([("Kore X2", SCORE_PAGES["lookup"]), ("Kore X3", "")], "asked string, html string"))
    resolved = ingest.page_results(ids.where("id = '42'").select("asked", F.lit("https://p.example/42").alias("url"), F.lit(page.replace("Kore X1", "Kore X2")).alias("html")))
    override = inline(spark, "(VALUES ('Kore X5'), ('Kore X6')) AS t(asked)").join(ingest.page_results(of(("Kore X5", page.replace("Kore X1", "Kore X5")))).select("asked", "mark", "single", "url"), "asked", "left")
    names = inline(spark, "(VALUES ('Kore X1'), ('Kore X2'), ('Kore X3'), ('Kore X5'), ('Kore X6')) AS t(asked)")
    return ingest.first_of(names, override, direct, resolved).select("asked", "mark", "single", "how")


def _entity(**claims: list) -> str:
    time = lambda t: {"mainsnak": {"datavalue": {"value": {"time": t}}}} if t else {"mainsnak": {}}
    return json.dumps({"claims": {p: [time(t) for t in times] for p, times in claims.items()}})


@query(_rows("rank, title, url, year", "(0, 'Kore X1', 'https://www.wikidata.org/wiki/Q1', 2007)", "(1, 'Kore', 'https://www.wikidata.org/wiki/Q2', 2011)", "(2, 'K', 'https://www.wikidata.org/wiki/Q3', NULL)"))
def s28_entity_search(spark, d):
    """Labels, else what matched; the first year of inception, else of publication."""
    hits = {"search": [{"id": "Q1", "label": "Kore X1"}, {"id": "Q2", "match": {"text": "Kore"}}, {"id": "Q3", "label": "K"}]}
    entities = [("Q1", _entity(P571=[None, "+2007-02-19T00:00:00Z"], P577=["+2009-01-01T00:00:00Z"])), ("Q2", _entity(P577=["bad", "+2011-00-00T00:00:00Z"])), ("Q3", "{}")]
    return ingest.search_hits(spark.createDataFrame([("Kore X1", json.dumps(hits))], "asked string, body string"), spark.createDataFrame(entities, "id string, body string")).drop("asked")


@query(_rows("asked, rank, title, url", "('a', 0, 'A one', 'https://w.example/1')", "('a', 1, 'A two', '')"))
def s29_open_search(spark, d):
    return ingest.opensearch_hits(spark.createDataFrame([("a", '["a",["A one","A two"],["",""],["https://w.example/1"]]'), ("b", '["b"]'), ("c", "{broken")], "asked string, body string"))


@query(f"SELECT category, path, (raw ->> '$.slug') AS slug FROM {DOCS} WHERE category IN ('brand', 'soc', 'smartphone', 'tablet', 'watch', 'pda', 'gpu', 'cpu')")
def s06_document_trees(spark, d):
    """Documents written as files below the shared folder and read again, category by category."""
    root = shared_path(spark, "tree")
    sinks.write_files(inline(spark, DOCS).select("path", F.concat(F.lit("﻿"), "raw").alias("text")), root)
    return documents.categories(spark, root).select("category", "path", F.try_variant_get("doc", "$.slug", "string").alias("slug"))


@query(f"SELECT DISTINCT raw ->> '$.slug' AS slug FROM {DOCS} WHERE category = 'brand' AND json_type(raw, '$.slug') = 'VARCHAR' AND path LIKE 'brand/us/%'")
def s03_curated_slugs(spark, d):
    root = shared_path(spark, "tree")
    sinks.write_files(inline(spark, DOCS).select("path", F.col("raw").alias("text")), root)
    return documents.curated_slugs(spark, root, "brand", "us")


# ---- Ingest -------------------------------------------------------------------------

_KEYS = "category, manufacturer, slug"
_SORTED = (
    f"(WITH c AS (SELECT DISTINCT {_KEYS} FROM ingest_candidates WHERE batch_no = 0), n AS (SELECT i.*, c.category IS NOT NULL AS held, len(i.missing_fields) = 0 AS fits FROM ingest_candidates i LEFT JOIN c ON i.category = c.category AND i.manufacturer = c.manufacturer AND i.slug = c.slug WHERE i.batch_no > 0) "
    "SELECT *, CASE WHEN held THEN 'existing' WHEN fits AND ingest_id = first THEN 'written' WHEN ingest_id > first THEN 'duplicate' ELSE 'incomplete' END AS outcome FROM (SELECT *, min(ingest_id) FILTER (NOT held AND fits) OVER (PARTITION BY category, manufacturer, slug) AS first FROM n))"
)


def _sorted(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "ingest_candidates").select("ingest_id", "batch_no", "category", "manufacturer", "slug", "missing_fields", "output_path", "record")
    return ingest.sorted_out(i.where("batch_no > 0"), i.where("batch_no = 0"), ["ingest_id"])


@query(f"SELECT ingest_id, outcome FROM {_SORTED}")
def q12_ingest(spark, d):
    """New batches against the curated history: J10, W04, F11."""
    return _sorted(spark, d).select("ingest_id", "outcome")


@query(f"SELECT outcome, count(*) AS n FROM {_SORTED} GROUP BY 1")
def a18_ingest_outcomes(spark, d):
    return ingest.outcome_counts(_sorted(spark, d))


@query(f"SELECT count(*) AS documents, count(DISTINCT output_path) AS paths FROM {_SORTED} WHERE outcome = 'written' AND json_valid(record)")
def k04_written_documents(spark, d):
    """The documents that ingest writes, as texts; written below the shared folder and read again."""
    new = _sorted(spark, d).where("outcome = 'written'").select("output_path", sinks.pretty("record").alias("text")).where("text is not null")
    root = shared_path(spark, "drafts")
    # A path names one file; candidates whose slugs differ may share it.
    n = sinks.write_files(new.select(F.concat(F.monotonically_increasing_id().cast("string"), F.lit("/"), "output_path").alias("path"), "text"), root)
    return documents.json_tree(spark, root).agg(F.lit(n).cast("bigint").alias("documents"), F.count_distinct(F.regexp_replace("path", "^[0-9]+/", "")).alias("paths"))


@query("SELECT slug, min(ingest_id) AS ingest_id FROM ingest_candidates WHERE batch_no > 0 AND slug IS NOT NULL AND slug NOT IN (SELECT slug FROM ingest_candidates WHERE batch_no = 0 AND slug IS NOT NULL) GROUP BY 1")
def k01_inserted(spark, d):
    """Insert if absent, for real: history is inserted, then all new rows; what the second insert added."""
    i = table(spark, d, "ingest_candidates").select("slug", "ingest_id", "batch_no")
    path = shared_path(spark, "inserted")
    sinks.insert_if_absent(i.where("batch_no = 0").drop("batch_no"), path, "slug", "ingest_id")
    return sinks.insert_if_absent(i.where("batch_no > 0").drop("batch_no"), path, "slug", "ingest_id")[0]


@query(" UNION ALL ".join(f"SELECT '{n}' AS collection, count(*) AS records, {s} AS scored FROM {latest(t)}" for n, t, s in (("socs", "socs", "count(geekbench_multi)"), ("brands", "brands", "0"))))
def k02_manifest(spark, d):
    """K02's manifest, A02 and A03."""
    s = counting_rows(table(spark, d, "socs"), "id", "updated_at", "geekbench_multi").withColumnRenamed("geekbench_multi", "overall")
    return sinks.manifest({"socs": s, "brands": counting_rows(table(spark, d, "brands"), "id", "updated_at", "slug")})


# ---- Enrichment ---------------------------------------------------------------------

PARTS = """(VALUES
 ('a.json', 'a', 'Kore X1 Processor', DATE '2021-01-01', NULL, NULL, 'https://o.example'), ('b.json', 'b', 'KORE-X2 @ 3.2GHz', DATE '2019-01-01', NULL, 50.0, ''), ('c.json', 'c', 'Kore X3', DATE '2018-01-01', 10.0, NULL, ''), ('d.json', 'd', 'Kore X4', NULL, NULL, NULL, ''),
 ('e.json', 'e', 'Kore X5', DATE '2020-05-05', NULL, NULL, ''), ('f.json', 'f', 'Kore X6 (Lake)', DATE '2022-01-01', NULL, 7.0, 'https://s.example/x'), ('g.json', 'g', 'Kore X7', DATE '2030-01-01', NULL, NULL, ''), ('h.json', 'h', 'Kore X8', DATE '2021-01-01', NULL, NULL, '')
) AS t(path, slug, name, release_date, passmark, cinebench, urls)"""
TOLD = "(VALUES ('korex1', 100.0, 200.0), ('korex2', 101.0, 201.0), ('korex3', 102.0, 202.0), ('korex6', NULL, 203.0), ('korex8', 104.0, NULL)) AS t(key, passmark, cinebench)"
_URL = "https://s.example/x"


@query(
    f"WITH p AS (SELECT *, passmark IS NULL AS open, passmark IS NULL AND coalesce(left(release_date::VARCHAR, 4), '0') >= '2019' AND coalesce(left(release_date::VARCHAR, 4), '0') <= '2025' AS inside, regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(name, '\\s*@\\s*[\\d.]+\\s*ghz', '', 'gi'), '\\b(processor|cpu)\\b', '', 'gi'), '\\s*\\([^)]*\\)', '', 'g')), '[^a-z0-9]+', '', 'g') AS key FROM {PARTS}), "
    f"a AS (SELECT p.*, inside AND row_number() OVER (PARTITION BY inside ORDER BY path) <= 4 AS asked, s.passmark AS sp, s.cinebench AS sc, s.key IS NOT NULL AS hit FROM p LEFT JOIN {TOLD.replace('AS t(', 'AS s(')} ON p.key = s.key), "
    "o AS (SELECT *, CASE WHEN NOT open THEN 'already' WHEN NOT asked THEN 'skipped' WHEN NOT hit THEN 'unresolved' WHEN sp IS NOT NULL OR (cinebench IS NULL AND sc IS NOT NULL) THEN 'filled' ELSE 'already' END AS outcome FROM a) "
    f"SELECT path, CASE WHEN asked THEN coalesce(passmark, sp) ELSE passmark END::DOUBLE AS passmark, CASE WHEN asked THEN coalesce(cinebench, sc) ELSE cinebench END::DOUBLE AS cinebench, CASE WHEN outcome = 'filled' AND NOT contains(urls, '{_URL}') THEN trim(urls || ' {_URL}') ELSE urls END AS urls, outcome FROM o"
)
def q13_enriched(spark, d):
    """Nulls filled by normalised name, within years and a budget of four records in path order."""
    p = inline(spark, PARTS).withColumns({n: F.col(n).cast("double") for n in ("passmark", "cinebench")})
    p = p.withColumn("source_urls", F.when(F.col("urls") == "", F.array().cast("array<string>")).otherwise(F.split("urls", " "))).drop("urls")
    told = inline(spark, TOLD)
    pairs = F.filter(F.array(*[F.struct(F.lit(n).alias("k"), F.col(n).cast("double").alias("v")) for n in ("passmark", "cinebench")]), lambda x: x["v"].isNotNull())
    scores = told.select("key", F.map_from_entries(pairs).alias("scores"), F.lit(_URL).alias("url"))
    out = ingest.enriched(p, scores, parsers.cpu_key, "passmark", ["passmark", "cinebench"], "path", (2019, 2025), 4)
    return out.select("path", "passmark", "cinebench", F.array_join("source_urls", " ").alias("urls"), "outcome")


@query(
    f"WITH s AS (SELECT regexp_replace(lower(title), '[^a-z0-9]+', '', 'g') AS key, max(release_year)::DOUBLE AS y FROM crossref_candidates WHERE release_year IS NOT NULL GROUP BY 1) SELECT id, CASE WHEN s.y IS NOT NULL AND tdp_w IS NULL THEN 'filled' WHEN tdp_w IS NOT NULL THEN 'already' ELSE 'unresolved' END AS outcome FROM {latest('cpus')} c LEFT JOIN s ON s.key <> '' AND regexp_replace(lower(c.name), '[^a-z0-9]+', '', 'g') = s.key"
)
def j12_enrich_by_name(spark, d):
    """Processors without tdp_w look for a value under their heading among the upstream entries."""
    from specloom.functions.text import normalize_heading

    e = table(spark, d, "crossref_candidates").where("release_year is not null").groupBy(normalize_heading(F.col("title")).alias("key")).agg(F.max("release_year").cast("double").alias("y")).where("key <> ''")
    scores = e.select("key", F.create_map(F.lit("tdp_w"), F.col("y")).alias("scores"), F.lit(_URL).alias("url"))
    c = counting_rows(table(spark, d, "cpus"), "id", "updated_at", "name", "release_date", "tdp_w").withColumn("source_urls", F.array().cast("array<string>"))
    return ingest.enriched(c, scores, normalize_heading, "tdp_w", ["tdp_w"], "id").select("id", "outcome")


SCORE_MAPS = "(VALUES (1, 'cinebench_r15_single', 300.0), (1, 'cinebench_r23_multi', 20000.0), (2, 'geekbench_multi', 9000.0), (3, 'cinebench_r15_multi', 1500.0)) AS t(n, field, value)"


@query(f"SELECT n, count(*) FILTER (starts_with(field, 'cinebench_r15')) AS kept FROM {SCORE_MAPS} GROUP BY 1")
def c07_prefix_of_keys(spark, d):
    maps = inline(spark, SCORE_MAPS).groupBy("n").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("scores"))
    return maps.select("n", F.size(ingest.with_prefix(F.col("scores"), "cinebench_r15")).cast("bigint").alias("kept"))


# ---- Coverage and integrity ---------------------------------------------------------

_UP = "(SELECT category, coalesce(manufacturer, '') AS manufacturer, slug, name, url, source, point_id FROM coverage_points WHERE slug IS NOT NULL)"
_HELD = "(SELECT DISTINCT category, manufacturer, slug FROM ingest_candidates WHERE slug IS NOT NULL AND manufacturer IS NOT NULL)"
_TOTALS = f"SELECT u.category, u.manufacturer, count(DISTINCT u.slug) AS upstream, coalesce(any_value(h.n), 0) AS curated, count(DISTINCT u.slug) FILTER (c.slug IS NULL) AS missing FROM {_UP} u LEFT JOIN {_HELD} c ON u.category = c.category AND u.manufacturer = c.manufacturer AND u.slug = c.slug LEFT JOIN (SELECT category, manufacturer, count(*) AS n FROM {_HELD} GROUP BY 1, 2) h ON u.category = h.category AND u.manufacturer = h.manufacturer GROUP BY 1, 2"


def _gaps(spark: SparkSession, d: str):
    p = table(spark, d, "coverage_points").where("slug is not null").select("category", F.coalesce("manufacturer", F.lit("")).alias("manufacturer"), "slug", "name", "url", "source", F.col("point_id").alias("row_no"))
    held = table(spark, d, "ingest_candidates").where("slug is not null and manufacturer is not null").select("category", "manufacturer", "slug")
    return ingest.coverage_gaps(p, held, 3)


@query(_TOTALS)
def q14_coverage(spark, d):
    return _gaps(spark, d)[0]


@query(
    f"SELECT category, manufacturer, slug, arg_min(name, (source, point_id)) AS name, greatest(count(*) OVER (PARTITION BY category, manufacturer) - 3, 0) AS more FROM {_UP} u WHERE NOT EXISTS (SELECT 1 FROM {_HELD} c WHERE c.category = u.category AND c.manufacturer = u.manufacturer AND c.slug = u.slug) GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY category, manufacturer ORDER BY slug) <= 3"
)
def o05_missing_top(spark, d):
    """The first three missing slugs of each maker, and how many more there are."""
    return _gaps(spark, d)[1].select("category", "manufacturer", "slug", "name", "more")


@query(f"SELECT 'slug' AS what, slug AS value, count(*) AS n, array_to_string(list_sort(list(id::VARCHAR)), ',') AS ids FROM {latest('brands')} WHERE slug IS NOT NULL GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'name', name, count(*), array_to_string(list_sort(list(id::VARCHAR)), ',') FROM {latest('brands')} WHERE name IS NOT NULL GROUP BY 2 HAVING count(*) > 1")
def a13_duplicate_lists(spark, d):
    c = counting_rows(table(spark, d, "brands"), "id", "updated_at", "slug", "name")
    twice = lambda n: c.where(F.col(n).isNotNull()).groupBy(F.col(n).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list(F.col("id").cast("string"))), ",").alias("ids")).where("n > 1").select(F.lit(n).alias("what"), "value", "n", "ids")
    return twice("slug").unionByName(twice("name"))


NAMED = "(VALUES ('AMD Ryzen 7 5800X'), ('AMD Ryzen 5 5800X'), ('AMD Ryzen 9 7900'), ('AMD Ryzen 7 7600X3D'), ('AMD Ryzen 5 5600G'), ('AMD Ryzen 3 3300X'), ('AMD Ryzen 7 2700XT'), ('Other 5 5800X')) AS t(name)"
MARKED = "(VALUES ('a', DATE '2004-01-01', 1600, 100, 90, 4), ('b', DATE '2004-01-01', 1500, 3500, NULL, 2), ('c', NULL, 9000, NULL, 1200, 1), ('d', DATE '2010-12-31', 2000, 3001, 3002, 8), ('e', DATE '2011-01-01', 2000, 9000, 9500, NULL), ('f', DATE '2020-01-01', 50000, 30000, 2000, 16)) AS t(name, release_date, passmark_cpu_mark, cinebench_r23_multi, cinebench_r23_single, threads)"


@query(f"SELECT name, regexp_extract(name, '^AMD Ryzen (\\d) ', 1) AS line, CASE regexp_extract(name, '^AMD Ryzen \\d \\d(\\d)', 1) WHEN '6' THEN '5' WHEN '9' THEN '9' ELSE '7' END AS expected FROM {NAMED} WHERE regexp_matches(name, '^AMD Ryzen \\d \\d[6789]\\d\\d(?:X3D|X|XT)?$') AND CASE regexp_extract(name, '^AMD Ryzen \\d \\d(\\d)', 1) WHEN '6' THEN '5' WHEN '9' THEN '9' ELSE '7' END <> regexp_extract(name, '^AMD Ryzen (\\d) ', 1)")
def q15_line_tiers(spark, d):
    return ingest.line_tiers(inline(spark, NAMED))


@query(f"SELECT name, 'passmark_cpu_mark' AS field FROM {MARKED} WHERE coalesce(left(release_date::VARCHAR, 4), '0') < '2006' AND passmark_cpu_mark > 1500 UNION ALL SELECT name, 'cinebench_r23_multi' FROM {MARKED} WHERE coalesce(left(release_date::VARCHAR, 4), '0') < '2011' AND cinebench_r23_multi > 3000")
def q15_era_breaks(spark, d):
    return ingest.era_breaks(inline(spark, MARKED))


@query(f"SELECT name FROM {MARKED} WHERE cinebench_r23_single > cinebench_r23_multi AND cinebench_r23_multi <> 0 AND coalesce(nullif(threads, 0), 1) > 1")
def q15_single_over_multi(spark, d):
    single, multi = F.col("cinebench_r23_single"), F.col("cinebench_r23_multi")
    return inline(spark, MARKED).where((single != 0) & (multi != 0) & (single > multi) & (F.coalesce(F.nullif("threads", F.lit(0)), F.lit(1)) > 1)).select("name")


@query("SELECT id FROM " + latest("cpus") + " ORDER BY id LIMIT 5")
def o08_source_limit(spark, d):
    """A source stops after so many emitted rows, in its order."""
    return records.page(counting_rows(table(spark, d, "cpus"), "id", "updated_at", "slug").select("id"), [F.col("id")], 0, 5)


# ---- Small sources, filters and sinks -----------------------------------------------


@query("SELECT ingest_id, CASE WHEN regexp_full_match(t, '\\d{4}-\\d{2}-\\d{2}') THEN try_strptime(t, '%Y-%m-%d')::DATE END AS release_date FROM (SELECT ingest_id, json_extract_string(record, '$.release_date') AS t FROM ingest_candidates WHERE json_valid(record))")
def s02_typed_dates(spark, d):
    """Texts in columns named *_date become dates, impossible ones null."""
    i = table(spark, d, "ingest_candidates").where(F.try_parse_json("record").isNotNull())
    return documents.with_typed_dates(i.select("ingest_id", F.get_json_object("record", "$.release_date").alias("release_date")))


@query(f"SELECT id, slug, country FROM {latest('brands')}")
def s09_json_lines(spark, d):
    """A log written as JSON lines and read again."""
    from specloom.operators import ledger

    path = shared_path(spark, "lines")
    ledger.write_lines(counting_rows(table(spark, d, "brands"), "id", "updated_at", "slug", "country").select("id", "slug", "country"), path)
    return documents.json_lines(spark, path, "id bigint, slug string, country string").select("id", "slug", "country")


@query("SELECT ingest_id, length(slug) >= CASE WHEN category = 'smartphone' THEN 3 ELSE 4 END AND (category = 'smartphone' OR regexp_matches(slug, '[0-9]')) AS fits, len(missing_fields) = 0 AS complete FROM ingest_candidates WHERE slug IS NOT NULL")
def f04_ingest_filters(spark, d):
    """slugs that ingest takes, and drafts with nothing missing."""
    phone = F.col("category") == "smartphone"
    fits = (F.length("slug") >= F.when(phone, 3).otherwise(4)) & (phone | F.col("slug").rlike("[0-9]"))
    return table(spark, d, "ingest_candidates").where("slug is not null").select("ingest_id", fits.alias("fits"), (F.size("missing_fields") == 0).alias("complete"))


@query(f"SELECT id, strftime(release_date, '%m-%d') = '01-01' AS placeholder FROM {latest('socs')} WHERE release_date IS NOT NULL")
def f08_placeholder_dates(spark, d):
    s = counting_rows(table(spark, d, "socs"), "id", "updated_at", "release_date")
    return s.where("release_date is not null").select("id", (F.date_format("release_date", "MM-dd") == "01-01").alias("placeholder"))


FLAGS = """(VALUES (1, '{
  "slug": "a",
  "verified": false
}'), (2, '{
  "verified": false,
  "x": 1
}'), (3, '{
  "verified": false,
  "y": {
    "verified": false
  },
  "verified": false
}'), (4, '{
  "verified": true
}'), (5, '{
  "verified": falsetto
}'), (6, NULL)) AS t(n, raw)"""


@query(f"SELECT n, CASE WHEN len(regexp_extract_all(raw, '(?m)^  \"verified\": false,?\\s*$')) = 1 THEN regexp_replace(raw, '(?m)^  \"verified\": false', '  \"verified\": true') END AS flipped FROM {FLAGS}")
def k07_flipped(spark, d):
    return inline(spark, FLAGS).select("n", sinks.flip_verified(F.col("raw")).alias("flipped"))
