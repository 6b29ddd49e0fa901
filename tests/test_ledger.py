"""Ledger, caches, hashes and reports."""

import hashlib
import json

from pyspark.sql import functions as F

from specloom.operators import ledger


def test_content_hash(spark):
    docs = [{"b": 1, "a": "é ☃", "c": [1.5, None, True]}, {}, [1, 2]]
    df = spark.createDataFrame([(json.dumps(d, indent=1),) for d in docs] + [(None,), ("{broken",)], "raw string")
    want = [hashlib.sha256(json.dumps(d, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:16] for d in docs]
    assert [r[0] for r in df.select(ledger.content_hash("raw")).collect()] == [*want, None, None]


def test_log_is_added_to_and_replaced(spark, tmp_path):
    one = spark.createDataFrame([("cpu", "a", 1), ("cpu", "b", 2)], "slug string, category string, line_no int")
    ledger.write_lines(one, f"{tmp_path}/log")
    ledger.write_lines(one.withColumn("line_no", F.col("line_no") + 10), f"{tmp_path}/log")
    lines = [r["value"] for r in spark.read.text(f"{tmp_path}/log").collect()]
    assert len(lines) == 4 and all(list(json.loads(x)) == ["category", "line_no", "slug"] for x in lines)
    back = spark.read.json(f"{tmp_path}/log")
    assert sorted(r["line_no"] for r in ledger.latest(back).collect()) == [11, 12]
    ledger.write_lines(one, f"{tmp_path}/log", replace=True)
    assert spark.read.text(f"{tmp_path}/log").count() == 2


def test_bar():
    assert ledger.band_bar(0, 0, 0) == "—" and ledger.band_bar(1, 0, 0) == "🟩" * 12
    assert ledger.band_bar(1000, 1, 1) == "🟩" * 10 + "🟨🟥"
    assert all(len(ledger.band_bar(a, b, c)) == 12 for a in range(0, 40, 3) for b in range(0, 40, 7) for c in range(1, 40, 5))


def test_status_keeps_its_time_without_a_change(spark):
    rollup = spark.createDataFrame([("ALL", 3), ("cpu", 1), ("soc", 2)], "category string, total int")
    first = ledger.status_document(rollup, "t1")
    assert list(first["categories"]) == ["cpu", "soc", "ALL"] and ledger.status_document(rollup, "t2", first) is first
    assert ledger.status_document(rollup.where("category <> 'soc'"), "t2", first)["generated_at"] == "t2"
    assert ledger.markdown_table(rollup.where("category = 'cpu'"), "Status") == "# Status\n\n| category | total |\n|---|---|\n| cpu | 1 |\n"


def test_pages_are_checked_host_by_host(spark):
    urls = spark.createDataFrame([("https://a.example/1",), ("https://a.example/2",), ("https://b.example/1",)], "url string")
    fetch = lambda many: [(200 + len(many), u) if "b." not in u else (None, None) for u in many]
    got = {r["url"]: (r["status"], r["final_url"]) for r in ledger.pages_checked(urls, fetch).collect()}
    assert got == {"https://a.example/1": (202, "https://a.example/1"), "https://a.example/2": (202, "https://a.example/2"), "https://b.example/1": (None, None)}
    assert ledger.pages_checked(urls.limit(0), fetch).count() == 0


def test_selection_of_none_and_without_bounds(spark):
    r = spark.createDataFrame([(1, "cpu", False, "a"), (2, "gpu", True, "b"), (3, "cpu", None, "c")], "n int, category string, verified boolean, path string")
    assert ledger.selected(r, ["cpu"], "n", most=0).count() == 0
    assert [x["n"] for x in ledger.selected(r, ["gpu", "cpu"], "n").collect()] == [2, 1, 3]
