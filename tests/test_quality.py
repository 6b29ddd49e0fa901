"""Exact ranks, cohorts, configuration and validation against brute force."""

import json
import random
import statistics

import pytest

from specloom.functions import mathx
from specloom.operators import records, scoring, validate
from specloom.plans import quality


def test_order_statistics_are_exact(spark, monkeypatch):
    """Small groups, and large ones through the sketch; ties, one hot group, nulls."""
    monkeypatch.setattr(records, "SKETCH", 100)
    rnd = random.Random(5)
    rows = [("hot", rnd.random()) for _ in range(20_000)] + [("ties", float(rnd.randint(1, 5))) for _ in range(3000)] + [("few", float(x)) for x in (3, 1, 2, 9)] + [("one", 7.0), ("none", None), (None, 1.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    by = {}
    for g, v in rows:
        if v is not None:
            by.setdefault(g, []).append(v)
    assert {r["g"]: (r["n"], r["median"]) for r in records.medians(df, ["g"], "v").collect()} == {g: (len(v), statistics.median(v)) for g, v in by.items()}
    at = lambda v, p: sorted(v)[round(p / 100 * (len(v) - 1))]
    got = {r["g"]: (r["lo"], r["hi"]) for r in records.rank_bounds(df, ["g"], "v").collect()}
    assert got == {g: (at(v, 1), at(v, 99)) for g, v in by.items() if len(v) >= 5}
    assert records.medians(df.limit(0), ["g"], "v").count() == 0


def test_percentiles_count_values(spark):
    rnd = random.Random(6)
    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice([None, *[x / 10 for x in range(0, 1001, 7)]])) for i in range(2000)]
    out = scoring.with_relative(spark.createDataFrame(rows, "id int, era string, idx double"), "idx")
    want = {}
    for i, e, x in rows:
        if e is None or x is None:
            want[i] = (None, None)
        else:
            peers = [y for _, f, y in rows if f == e and y is not None]
            want[i] = (round(100 * sum(y <= x for y in peers) / len(peers), 1), len(peers))
    assert {r["id"]: (r["percentile"], r["cohort"]) for r in out.collect()} == want
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]


def test_configuration_has_a_version(tmp_path):
    raw = {"algorithm_version": "2.0.0", "reference_scales": {"x": {"b": {"lo": 1, "hi": 10, "log": True}}}, "chains": {"x": {"d": ["b"]}}, "weights": {"x": {"d": 1}}, "era_bands": [[0, 9, "old"]], "tiers": [[50, "A"], [0, "B"]]}
    path = tmp_path / "scoring.json"
    path.write_text(json.dumps(raw))
    c = mathx.load_config(str(path))
    assert c["scales"]["x"]["b"] == mathx.Scale(1.0, 10.0, True, False) and c["era_bands"] == ((0, 9, "old"),) and c["tiers"][0] == (50.0, "A")
    path.write_text(json.dumps({**raw, "algorithm_version": "1.9"}))
    with pytest.raises(ValueError):
        mathx.load_config(str(path))
    path.write_text("[]")
    with pytest.raises(ValueError):
        mathx.load_config(str(path))


def test_validation_gives_a_row_per_rule(spark):
    docs = spark.sql(f"SELECT * FROM {quality.DOCS}").union(spark.createDataFrame([("cpu/x.json", "cpu", "{broken"), ("cpu/y.json", "cpu", None)], "path string, category string, raw string"))
    found = {}
    for r in validate.validate(docs).collect():
        found.setdefault(r["path"], set()).add((r["rule"], r["field"]))
    assert "brand/kr/saro.json" not in found and "cpu/volt/c1.json" not in found
    assert found["cpu/x.json"] == found["cpu/y.json"] == {("S01", "")}
    assert found["soc/saro/s2.json"] == {("V03", "process_nm"), ("V04", "release_date"), ("V05", "slug"), ("V11", "manufacturer")}
    assert found["cpu/volt/c2.json"] == {("V03", "cores"), ("V03", "threads"), ("V03", "msrp_usd"), ("V04", "release_date"), ("V06", "source_urls"), ("V11", "manufacturer"), ("V12", "segment")}
    assert ("V07", "brand") in found["smartphone/volt/2020/p2/p2.json"] and ("V01", "soc") in found["smartphone/saro/2021/p4.json"]
    assert validate.exit_code(validate.validate(docs)) == 1 and validate.exit_code(validate.validate(docs.where("path = 'brand/kr/saro.json'"))) == 0
    assert validate.validate(docs.limit(0)).count() == 0
