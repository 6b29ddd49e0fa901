"""Drafts, enrichment and reports on rows worked out by hand, and tables without rows."""

import json

from pyspark.sql import functions as F

from specloom.functions import parsers
from specloom.operators import ingest
from specloom.plans import ingesting
from specloom.sources import html


def test_makers_in_front_of_a_model(spark):
    table = {("amd", "Advanced Micro Devices Ryzen 5"): "ryzen-5", ("amd", "AMD"): "", ("apple", "Apple Inc. A9"): "a9", ("volt+", "VOLT+ X1"): "x1", ("volt", "Voltage X1"): "voltage-x1", ("x", None): None, ("saro", "Saró Ñ 5"): "saro-n-5"}
    df = spark.createDataFrame([(i, m, n) for i, (m, n) in enumerate(table)], "i int, m string, n string")
    got = {r["i"]: r["s"] for r in df.select("i", ingest.model_slug(F.col("n"), F.col("m")).alias("s")).collect()}
    # Only a leading maker goes, accents fold before.
    assert [got[i] for i in range(6)] == list(table.values())[:6] and got[6] == "n-5"


def test_filled_documents(spark):
    doc = {"slug": "a", "name": "Ä", "x": None, "y": 5, "source_urls": ["u"]}
    rows = [(json.dumps(doc), '{"x":7.0,"y":9.0,"z":1.5}', "v"), (json.dumps(doc), '{"x":1.0}', "u"), (json.dumps(doc), '{"y":1.0}', "v"), ("{broken", '{"x":1.0}', "v"), (None, '{"x":1.0}', "v"), ("[1]", '{"x":1.0}', "v"), ("{}", None, "v")]
    got = [r[0] for r in spark.createDataFrame(rows, "raw string, scores string, url string").select(ingest.filled_document("raw", "scores", "url")).collect()]
    assert json.loads(got[0]) == {**doc, "x": 7, "z": 1.5, "source_urls": ["u", "v"]} and '"x": 7,' in got[0] and "Ä" in got[0] and got[0].endswith("\n")
    assert json.loads(got[1])["source_urls"] == ["u"] and got[2:] == [None] * 5


def test_candidates_sorted_out(spark):
    rows = [(1, "s1", ["a"]), (2, "s1", []), (3, "s1", []), (4, "s1", ["a"]), (5, "s2", []), (6, "s3", ["a"]), (7, None, [])]
    c = spark.createDataFrame(rows, "n int, slug string, missing_fields array<string>").withColumns({"category": F.lit("cpu"), "manufacturer": F.lit("m")})
    held = c.where("n = 5")
    out = lambda **k: {r["n"]: r["outcome"] for r in ingest.sorted_out(c, held, ["n"], **k).collect()}
    assert out() == {1: "incomplete", 2: "written", 3: "duplicate", 4: "duplicate", 5: "existing", 6: "incomplete", 7: "written"}
    assert out(include_drafts=True) == {1: "written", 2: "duplicate", 3: "duplicate", 4: "duplicate", 5: "existing", 6: "written", 7: "written"}
    assert ingest.sorted_out(c.limit(0), held, ["n"]).count() == 0


def test_coverage_report_text(spark):
    points = spark.createDataFrame([("cpu", "volt", f"x{i}", f"X{i}", "" if i else "u", "s", i) for i in range(5)] + [("gpu", "volt", "y", "Y", "", "s", 1)], "category string, manufacturer string, slug string, name string, url string, source string, row_no int")
    held = spark.createDataFrame([("cpu", "volt", "x4"), ("gpu", "volt", "y"), ("gpu", "volt", "z")], "category string, manufacturer string, slug string")
    assert ingest.coverage_markdown(*ingest.coverage_gaps(points, held, 3)) == (
        "# Coverage gaps\n\n**Total missing:** 4\n\n## cpu / volt: 4 missing (upstream 5, curated 1)\n- `x0` X0 ([source](u))\n- `x1` X1\n- `x2` X2\n_and 1 more_\n\n## gpu / volt: 0 missing (upstream 1, curated 2)\n_(none)_\n"
    )
    assert ingest.coverage_markdown(*ingest.coverage_gaps(points.limit(0), held)) == "# Coverage gaps\n\n**Total missing:** 0\n"


def test_pages_that_fail_are_left_out(spark):
    pages = spark.createDataFrame([("volt", "A"), ("volt", "B")], "manufacturer string, title string")

    def fetch(title):
        if title == "B":
            raise OSError(title)
        return ingesting.CPU_PAGE

    got = html.fetch_pages(pages, fetch)
    assert [r["title"] for r in got.collect()] == ["A"]
    assert ingest.drafts(got.withColumn("clash", F.lit(1)), "cpu").count() == 4 and ingest.drafts(got.limit(0), "cpu").count() == 0
    assert ingest.coverage_points(got.limit(0), "gpu").count() == 0


def test_readers_of_odd_pages():
    for page in (None, "", "<table>", "<table><tr><td></table>", "<div class='tab'><h4>", "</div></p>" * 50, "<input data-cmp value=x>", "text"):
        for read in (lambda p: html.name_single_multi(p, "x"), html.wide_benchmarks, lambda p: html.system_results(p, "x"), lambda p: html.tabbed_page(p, lambda _: "x"), lambda p: html.ranking(p, "x"), lambda p: html.listed_parts(p, "x"), html.looked_up, lambda p: html.field_rows(p, ingest.HEADERS["cpu"]), html.first_cells):
            assert list(read(page)) == []
    assert html.part_page(None) == ("", "")


def test_enrichment_without_scores_or_records(spark):
    r = spark.createDataFrame([("a", "Kore X1", None, None, None)], "path string, name string, release_date date, mark double, source_urls array<string>")
    none = spark.createDataFrame([], "key string, scores map<string,double>, url string")
    assert [x["outcome"] for x in ingest.enriched(r, none, parsers.cpu_key, "mark", ["mark"]).collect()] == ["unresolved"]
    assert ingest.enriched(r.limit(0), none, parsers.cpu_key, "mark", ["mark"], limit=3).count() == 0
    hit = spark.createDataFrame([("korex1", {"mark": 5.0}, "u")], "key string, scores map<string,double>, url string")
    got = ingest.enriched(r, hit, parsers.cpu_key, None, ["mark"]).first()
    assert (got["mark"], got["source_urls"], got["outcome"]) == (5.0, ["u"], "filled")
    assert [x["outcome"] for x in ingest.enriched(r, hit, parsers.cpu_key, "mark", ["mark"], limit=0).collect()] == ["skipped"]
    assert [x["outcome"] for x in ingest.enriched(r, hit, parsers.cpu_key, "mark", ["mark"], years=(1990, None)).collect()] == ["skipped"]
