"""HTML tables, document trees, sinks and verification."""

import json
import zipfile

from pyspark.sql import functions as F

from specloom.operators import verify
from specloom.sources import documents, html, sinks

PAGE = """<h3>Raptor</h3><table class="wikitable sortable"><tr><th>Model</th><th>Cores</th><th colspan="2">Clock</th></tr>
<tr><td rowspan="2">i9<sup>[1]</sup> K</td><td>8</td><td>3</td><td>5</td></tr><tr><td>16</td><td>3</td><td>5</td></tr><tr><td></td><td></td></tr></table><table><tr><td>other</td></tr></table>"""


def test_html(spark):
    html.register(spark)
    spark.createDataFrame([(1, PAGE), (2, None), (3, "no table")], "id int, page string").createOrReplaceTempView("pages")
    rows = spark.sql("select id, heading, row_no, cells from pages, lateral html_rows(page) order by row_no").collect()
    assert [(r["heading"], r["cells"]["Model"], r["cells"]["Cores"]) for r in rows] == [("Raptor", "i9 [1] K", "8"), ("Raptor", "i9 [1] K", "16")]
    assert [r["text"] for r in spark.sql("select text from pages, lateral html_first_cells(page) order by row_no").collect()] == ["i9 K", "i9 K"]


def test_documents(spark, tmp_path):
    (tmp_path / "t/cpu/a").mkdir(parents=True)
    (tmp_path / "t/cpu/a/x.json").write_text("﻿" + json.dumps({"slug": "x", "release_date": "2023-02-30"}, indent=2))
    (tmp_path / "t/cpu/y.json").write_text("{broken")
    got = {r["path"]: r["slug"] for r in documents.json_tree(spark, str(tmp_path / "t")).select("path", F.try_variant_get("doc", "$.slug", "string").alias("slug")).collect()}
    assert got == {"cpu/a/x.json": "x", "cpu/y.json": None}
    (tmp_path / "t/cpu/_note.json").write_text('{"slug":"hidden é"}')
    (tmp_path / "t/cpu/a/n + o.json").write_text('{"slug":7}')
    assert {r["path"] for r in documents.json_tree(spark, str(tmp_path / "t")).collect()} == {"cpu/a/x.json", "cpu/y.json", "cpu/_note.json", "cpu/a/n + o.json"}
    assert {r["path"] for r in documents.json_tree(spark, f"file://{tmp_path}/t", hidden=False).collect()} == {"cpu/a/x.json", "cpu/y.json", "cpu/a/n + o.json"}
    assert {r["slug"] for r in documents.curated_slugs(spark, f"{tmp_path}/t", "cpu").collect()} == {"x", "hidden é"}
    assert documents.curated_slugs(spark, f"{tmp_path}/t", "gpu", "none").count() == 0
    assert {r["path"] for r in documents.candidates(spark, f"{tmp_path}/t", "cpu", "a").collect()} == {"cpu/a/x.json", "cpu/a/n + o.json"}
    assert {(r["category"], r["path"]) for r in documents.categories(spark, f"{tmp_path}/t", ("cpu", "gpu"), hidden=False).collect()} == {("cpu", "cpu/a/x.json"), ("cpu", "cpu/y.json"), ("cpu", "cpu/a/n + o.json")}
    (tmp_path / "ids.json").write_text('{"A 1": "77", "B": 5}')
    assert {tuple(r) for r in documents.override_map(spark, f"{tmp_path}/ids.json").collect()} == {("A 1", "77"), ("B", "5")}
    assert documents.data_root({"SPECLOOM_DATA": "/x"}) == "/x" and documents.data_root({}, start=str(tmp_path)).endswith("/data")
    assert documents.with_typed_dates(spark.createDataFrame([("2023-01-02", "2023-02-30")], "a_date string, b_date string")).first()["b_date"] is None
    (tmp_path / "l.jsonl").write_text('{"a":1}\n\n{"a":2}\n')
    assert [r["a"] for r in documents.json_lines(spark, str(tmp_path / "l.jsonl"), "a int").orderBy("line_no").collect()] == [1, 2]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("d.jsonl", '{"a":1}\n\n{"a":2}\n')
    assert documents.zipped_json_lines(spark, str(tmp_path / "z.zip")).count() == 2


def test_sinks(spark, tmp_path):
    a = spark.createDataFrame([("x", 1), ("y", 2), ("y", 2)], "slug string, v int")
    assert sinks.insert_if_absent(a, f"{tmp_path}/t")[1] == {"given": 3, "inserted": 2}
    sinks.insert_if_absent(spark.createDataFrame([("y", 9), ("z", 3)], "slug string, v int"), f"{tmp_path}/t")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/t").collect())) == [("x", 1), ("y", 2), ("z", 3)]
    raw = '{\n  "verified": false,\n  "in": {\n    "verified": false\n  }\n}\n'
    df = spark.createDataFrame([(raw,), ("{}",), (raw + raw,)], "raw string")
    assert [r[0] for r in df.select(sinks.flip_verified(F.col("raw"))).collect()] == [raw.replace("false", "true", 1), None, None]
    assert [tuple(r) for r in sinks.manifest({"a": a, "b": a.withColumn("overall", F.lit(1.0))}).orderBy("collection").collect()] == [("a", 3, 0), ("b", 3, 3)]


def test_verify(spark):
    df = spark.createDataFrame([(["https://en.wikipedia.org/a", "https://x.gsmarena.com/b"],), (["https://www.kaggle.com/x"],), (["https://example.org"],), ([],), (None,)], "u array<string>")
    assert [tuple(r) for r in df.select(verify.best_tier(F.col("u")), verify.host_score(F.col("u"))).collect()] == [(1, 30.0), (3, 6.0), (0, 3.0), (0, 3.0), (0, 3.0)]
    rec = spark.createDataFrame([(1, "Core X1", 2020), (2, "Core X2", 2020), (3, "Core X3", None), (4, "None", 2020), (5, "Alone", 2020), (6, " ", 2020)], "record_id int, name string, year int")
    cand = spark.createDataFrame([(1, 0, "Core X1", None), (1, 1, "ACME Core X1", 2021), (2, 0, "core-x2", 2015), (3, 0, "Core X3", 2000), (4, 0, "other", 2020), (6, 0, "", 2020)], "record_id int, rank int, title string, year int")
    got = {r["record_id"]: r["decision"] for r in verify.crossref(rec, cand).collect()}
    assert got == {1: "confirm", 2: "contradict", 3: "ambiguous", 4: "ambiguous", 5: "notfound", 6: "notfound"}
    p = spark.createDataFrame([("green", "contradict"), ("red", "confirm"), ("green", None), ("red", None)], "b string, d string").select(verify.promotion(F.col("b"), F.col("d")).alias("p")).collect()
    assert [tuple(r["p"]) for r in p] == [(False, "crossref-contradict"), (True, "crossref-confirm"), (True, "green"), (False, "needs-confirmation")]
    t = spark.sql("select timestamp'2024-01-08 00:00:00' now, timestamp'2024-01-01 00:00:01' a, cast(null as timestamp) b")
    assert tuple(t.select(verify.fresh(F.col("a"), F.col("now"), 7), verify.fresh(F.col("b"), F.col("now"), 7)).first()) == (True, False)


def test_changed_paths(spark, tmp_path):
    import subprocess

    git = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=t", "-c", "user.email=t@t", *a], check=True, capture_output=True)
    git("init", "-q")
    (tmp_path / "data/cpu").mkdir(parents=True)
    (tmp_path / "data/cpu/a.json").write_text("{}")
    git("add", "-A")
    git("commit", "-qm", "one")
    git("branch", "base")
    (tmp_path / "data/cpu/b.json").write_text("{}")
    (tmp_path / "other.json").write_text("{}")
    git("add", "-A")
    git("commit", "-qm", "two")
    assert [r["path"] for r in documents.changed_paths(spark, str(tmp_path), "base").collect()] == ["cpu/b.json"]
    assert documents.changed_paths(spark, str(tmp_path), "nowhere").count() == 0


def test_static_files(spark, tmp_path):
    """List, detail and score files and the manifest; the flag of a file is flipped in place."""
    refs = spark.createDataFrame([("b", "Bé", "/v1/cpus/b"), ("a", "A", "/v1/cpus/a")], "slug string, name string, url string")
    details = spark.createDataFrame([("a", 8, None), ("b", 4, "x")], "slug string, cores int, note string")
    scores = spark.createDataFrame([("a", 50.0), ("b", None)], "slug string, overall double")
    root = f"file://{tmp_path}/out"
    out = sinks.dump(root, {"cpus": refs, "games": refs.limit(0)}, {"cpus": details, "games": details.limit(0)}, {"cpus": scores})
    assert out == {"version": "v1", "collections": {"cpus": {"count": 2, "url": "/v1/cpus/index.json", "scored": 1}, "games": {"count": 0, "url": "/v1/games/index.json"}}}
    read = lambda p: json.loads((tmp_path / "out" / p).read_text())
    assert read("v1/index.json") == out and read("v1/games/index.json") == {"count": 0, "results": []}
    assert [r["slug"] for r in read("v1/cpus/index.json")["results"]] == ["a", "b"] and "Bé" in (tmp_path / "out/v1/cpus/index.json").read_text()
    assert read("v1/cpus/a/index.json") == {"slug": "a", "cores": 8, "note": None} and read("v1/cpus/b/score/index.json")["overall"] is None
    assert (tmp_path / "out/v1/cpus/a/index.json").read_text().endswith('  "note": null\n}\n') and not list((tmp_path / "out").rglob("*.part"))
    doc = '{\n  "slug": "a",\n  "verified": false\n}\n'
    (tmp_path / "d.json").write_text(doc)
    rows = spark.createDataFrame([("d.json", doc), ("e.json", '{\n  "verified": false,\n  "verified": false\n}')], "path string, raw string")
    assert sinks.flip_file(rows, str(tmp_path)) == 1 and json.loads((tmp_path / "d.json").read_text())["verified"] is True
