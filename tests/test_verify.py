"""The offline score and what rests on it, on rows worked out by hand."""

import datetime as dt

from pyspark.sql import functions as F

from specloom.operators import verify


def test_tier0_scores_hosts_and_tiers(spark):
    """Green takes a source of tier 1 or 2, whatever the points; hosts count by their tier."""
    intel, arena, bulk, other = "https://www.intel.com/a", "https://gsmarena.com/b", "https://kaggle.com/c", "https://x.example/d"
    rows = {
        1: ([intel], True, True, ("green", 93.0, 1)),
        2: ([arena, intel, arena], True, True, ("green", 97.0, 1)),
        3: ([arena], True, True, ("green", 85.0, 2)),
        4: ([bulk], True, True, ("yellow", 73.0, 3)),
        5: ([], True, True, ("yellow", 70.0, 0)),
        6: (None, True, True, ("yellow", 70.0, 0)),
        7: ([other, None], True, False, ("red", 35.0, 0)),
        8: ([intel], True, False, ("red", 58.0, 1)),
        9: ([intel], False, None, ("yellow", 68.0, 1)),
        10: ([other], False, None, ("yellow", 45.0, 0)),
    }
    df = spark.createDataFrame([(i, u, r, s) for i, (u, r, s, _) in rows.items()], "id int, urls array<string>, rich boolean, ok boolean")
    got = {r["id"]: tuple(r["s"]) for r in df.select("id", verify.tier0([F.col("rich")], [(F.col("ok"), True)], F.col("urls")).alias("s")).collect()}
    assert got == {i: want for i, (_, _, _, want) in rows.items()}


def test_phone_signals(spark):
    day = dt.date
    rows = [
        (1, day(2020, 5, 1), ("1080x2340", 6.0, 430), [64, 128], "Android 10", 8, day(2022, 1, 1), [True, True, True, True, True, True]),
        (2, day(2018, 5, 1), ("1080x2340", 6.0, 300), [128, 64], "android 14", 256, day(2019, 3, 1), [False, False, False, True, False, False]),
        (3, day(2028, 5, 1), (None, 6.0, 300), [64, None], "Orbis 14", None, None, [None, False, None, False, None, None]),
        (4, None, ("1080x2340", 0.0, 300), [], None, 8, day(2019, 3, 1), [None, None, None, None, None, None]),
    ]
    df = spark.createDataFrame([r[:-1] for r in rows], "id int, release_date date, display struct<resolution:string,size_inch:double,ppi:int>, storage_options_gb array<int>, os string, ram_gb int, soc_date date")
    signals = verify.phone_signals(2026)
    got = {r["id"]: list(r["s"]) for r in df.select("id", F.array(*[s for s, _ in signals]).alias("s")).collect()}
    assert got == {r[0]: r[-1] for r in rows} and [hard for _, hard in signals] == [False, False, False, True, False, False]


def test_found_headings_lead_to_promotion(spark):
    """Entries are found by their headings, and decide together with the band."""
    records = spark.createDataFrame(
        [("a", "AMD Ryzen 7 5800X", 2020, "yellow"), ("b", "Ryzen 7 5800X", 2015, "green"), ("c", "Xy", 2020, "yellow"), ("d", "Other 12", 2020, "green"), ("e", " - ", 2020, "yellow"), ("f", None, 2020, "yellow"), ("g", "Zed 900", None, "yellow")],
        "record_id string, name string, year int, band string",
    )
    entries = spark.createDataFrame([("ryzen-7 5800x", 1, None), ("Ryzen 7 5800X", 2, 2021), ("Maker Xy", 3, 2021), ("X", 4, 2020), ("r 12", 5, 2010), ("", 6, 2020), (None, 7, 2020), ("Zed 900", 8, 2020)], "title string, rank bigint, year int")
    found = verify.found_headings(records, entries)
    assert {(r["record_id"], r["rank"]) for r in found.collect()} == {("a", 2), ("b", 2), ("c", 3), ("g", 8)}
    out = records.join(verify.crossref(records, found), "record_id").select("record_id", "decision", verify.promotion(F.col("band"), F.col("decision")).alias("p"))
    assert {r["record_id"]: (r["decision"], r["p"]["promote"]) for r in out.collect()} == {
        "a": ("confirm", True), "b": ("contradict", False), "c": ("confirm", True), "d": ("notfound", True), "e": ("notfound", False), "f": ("notfound", False), "g": ("ambiguous", False),
    }
    assert verify.found_headings(records, entries.limit(0)).count() == 0


def test_failed_names_hard_signals(spark):
    df = spark.createDataFrame([(False, False, True), (None, False, False)], "a boolean, b boolean, c boolean")
    signals = [(F.col("a"), True), (F.col("b"), False), (F.col("c"), True)]
    assert [r[0] for r in df.select(verify.failed(signals, ["x", "y"])).collect()] == [["!x"], ["!y"]]
