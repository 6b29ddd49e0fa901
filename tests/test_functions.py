"""Parsers and scoring primitives against exact tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from specloom.functions import mathx, parsers, text
from specloom.operators import records


def run(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["r"] for r in df.select("i", f(F.col("v")).alias("r")).orderBy("i").collect()]


D = datetime.date
CASES = [
    (parsers.frequency_ghz, {"2.4 GHz": 2.4, "2400 MHz": 2.4, "4.7 GHz Turbo": 4.7, "": None, "unknown": None, None: None}),
    (parsers.frequency_mhz, {"2235 MHz": 2235, "2.5 GHz": 2500, "2.01 GHz": 2009, "": None}),
    (parsers.tdp_w, {"35 W": 35, "45/115 W": 45, "170W": 170, "none": None}),
    (parsers.cache_mb, {"24 MB": 24.0, "256 KB": 0.25, "2 GB": 2048.0, "": None}),
    (parsers.memory_gb, {"20 GB": 20.0, "6144 MB": 6.0, "11GB": 11.0}),
    (parsers.memory_bus_bit, {"192-bit": 192, "64 bit": 64, "512bit": 512}),
    (parsers.pcie_version, {"PCIe 2.1 x8": "2.1", "PCI-e Gen 4": "4", "PCIe 1": "1", "none": None}),
    (parsers.ram_gb, {"4 GB": 4, "16GB": 16, "3 GB or 6 GB": 6, "256 MB": None, "none": None}),
    (parsers.battery_mah, {"3,750 mAh": 3750, "120 mAh": None, "88,000 mAh": None}),
    (parsers.weight_g, {"198 g": 198, "160.9 g": 160, "48 g": None, "2kg": None}),
    (parsers.first_int, {"16 cores": 16, "none": None}),
    (parsers.date, {"2021-06-09": D(2021, 6, 9), "June 9, 2021": D(2021, 6, 9), "9 June 2021": D(2021, 6, 9), "Q4 2020": D(2020, 10, 1), "2016": D(2016, 1, 1), "2021-02-30": None, "garbage": None, "": None}),
    (parsers.cpu_segment, {"Xeon Q 4410": "server", "Threadripper 3960X": "hedt", "Kore 12600K": "desktop", "Kore 12500H": "laptop", "Rizen 6980HX": "laptop"}),
    (parsers.soc_slug, {"Density 700 Plus": "density-700-plus", "MediaTek Density 700 for Orbit": "density-700", "Google Sensor 3": "sensor-3", "": ""}),
    (parsers.processor_of_system, {"RACK 9 (Acme Xe 410) HTML": "Acme Xe 410", "Box (Acme Xe 26 v2, 2.90 GHz)": "Acme Xe 26 v2", "none": None}),
    (parsers.host_of, {"https://User@WWW.Example.org:80/a": "example.org", "bare": "", None: ""}),
    (lambda c: text.slugify(c, ("intel", "acme")), {"Intel Core i9-14900K": "core-i9-14900k", "Café Au Lait": "cafe-au-lait", "acme": "", "": ""}),
]


@pytest.mark.parametrize("f,table", CASES)
def test_parsers(spark, f, table):
    assert run(spark, f, list(table)) == list(table.values())


def test_keys_keep_variants(spark):
    a, b, c, d = run(spark, parsers.gpu_key, ["GeForce RTX 4070", "NVIDIA GeForce RTX 4070/PCIe/SSE2", "RTX 4070 Ti", "Radeon RX 580 8GB"])
    assert a == b != c and d == "rx580"
    a, b, c = run(spark, parsers.cpu_key, ["AMD Ryzen 7 5800X @ 3.80GHz", "AMD Ryzen 7 5800X 8-Core Processor", "AMD Ryzen 7 5800X3D"])
    assert a == b != c


def test_os_and_pairs(spark):
    df = spark.createDataFrame([("Android 14, One UI 6.1", "samsung"), ("(unknown)", "apple"), ("(unknown)", "samsung"), ("", "apple")], "v string, b string")
    assert [r[0] for r in df.select(parsers.os_name(F.col("v"), F.col("b"))).collect()] == ["Android 14", "iOS", "Android", None]
    assert [tuple(r[0]) for r in spark.createDataFrame([("8 / 16",), ("16",), ("",)], "v string").select(parsers.cores_threads(F.col("v"))).collect()] == [(8, 16), (16, 16), (None, None)]


def test_scoring_vectors(spark):
    one = spark.range(1)
    lin, inv = mathx.Scale(0, 100, False), mathx.Scale(2, 7, False, True)
    v = lambda c: one.select(c.alias("x")).first()["x"]
    assert [v(mathx.capability(F.lit(x), lin)) for x in (-50, 150, 50)] == [0.0, 100.0, 50.0]
    assert v(mathx.capability(F.lit(None).cast("double"), lin)) is None
    assert [v(mathx.capability(F.lit(x), inv)) for x in (2, 7)] == [100.0, 0.0]
    assert v(mathx.capability(F.lit(3000), mathx.PHONE_SCALES["geekbench_single"])) == 93.9
    n = F.lit(None).cast("double")
    assert v(mathx.combine([(F.lit(80.0), 0.5), (n, 0.5)])) == 80.0 and v(mathx.combine([(n, 1.0)])) is None and v(mathx.combine([(F.lit(100.0), 0.25), (F.lit(0.0), 0.75)])) == 25.0
    assert [v(mathx.tier(F.lit(float(x)))) for x in (96, 80, 5, 0)] == ["S", "A", "E", "F"]
    assert v(mathx.py_round(F.lit(2.675), 2)) == round(2.675, 2)


def test_rounding_is_that_of_printing(spark):
    """Ties, near ties, large, small and negative numbers."""
    import random

    rnd = random.Random(8)
    values = [k / 20 for k in range(-400, 400)] + [k / 8 for k in range(200)] + [rnd.uniform(-200, 200) for _ in range(3000)] + [x + d for x in (0.05, 0.25, 2.675, 1.005, 99.95, 1e6 + 0.25) for d in (-1e-9, 0.0, 1e-9, 4e-16)] + [1e12 + 0.25, 1e15 + 0.5, 3e-9, -3e-9, 0.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for n in (0, 1, 2, 4):
        got = [r[0] for r in df.select(mathx.py_round(F.col("v"), n)).collect()]
        assert got[-1] is None and got[:-1] == [float(format(v, f".{n}f")) for v in values], n


def test_phone_vector(spark):
    from specloom.operators.scoring import phone_scores

    socs = spark.createDataFrame([(1, 3000, 9000, 2500000, 3.0)], "id bigint, geekbench_single int, geekbench_multi int, antutu_score int, process_nm double")
    p = spark.sql(
        "select 7L id, 'a' slug, 1L soc_id, 999 msrp_usd, 12 ram_gb, date'2024-01-01' release_date, 5000 battery_mah, 45 charging_wired_w, 15 charging_wireless_w, "
        "named_struct('refresh_hz', 120, 'brightness_nits', 2600, 'ppi', 460) display, array(named_struct('type', 'main', 'mp', 50D, 'ois', true), named_struct('type', 'ultrawide', 'mp', 12D, 'ois', false), named_struct('type', 'selfie', 'mp', 12D, 'ois', false)) cameras"
    )
    r = phone_scores(p, socs).first()
    assert (r["performance"], r["camera"], r["battery"], r["display"], r["overall"], r["value"], r["tier"]) == (86.7, 31.1, 67.9, 67.6, 63.3, 53.1, "S")


def test_page_links_and_bounds(spark):
    assert records.page_links(50, "/v1/x", {}, 0, 20) == {"count": 50, "next": "/v1/x?offset=20", "previous": None}
    assert records.page_links(50, "/v1/x", {"brand": "a"}, 40, 5)["previous"] == "/v1/x?brand=a&offset=35&limit=5"
    assert records.page_links(50, "/v1/x", {}, 40, 20)["next"] is None
    df = spark.createDataFrame([("a", float(i)) for i in range(100)] + [("b", 1.0)], "g string, v double")
    assert [tuple(r) for r in records.rank_bounds(df, ["g"], "v").collect()] == [("a", 100, 1.0, 98.0)]
    with pytest.raises(ValueError):
        records.page(df, [F.col("v")], 0, 101)
