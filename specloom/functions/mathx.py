"""Rounding and scoring primitives as column expressions."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scale:
    """The range that 0 and 100 stand for."""

    lo: float
    hi: float
    log: bool = True
    invert: bool = False


# The reference scales, weights, bands and tiers of scoring version 2.0.0.
SOC_SCALES = {"geekbench_single": Scale(153, 3640), "geekbench_multi": Scale(471, 10558), "antutu_score": Scale(102154, 3161830)}
PHONE_SCALES = {
    **SOC_SCALES,
    "ram_gb": Scale(2, 24, False),
    "battery_mah": Scale(1500, 6000, False),
    "charging_wired_w": Scale(5, 120, False),
    "charging_wireless_w": Scale(0, 50, False),
    "process_nm": Scale(2.0, 14.0, False, True),
    "brightness_nits": Scale(400, 3000, False),
    "ppi": Scale(250, 600, False),
    "refresh_hz": Scale(60, 165, False),
    "main_camera_mp": Scale(8, 200, False),
    "msrp_usd": Scale(200, 1600, False, True),
}
CPU_SCALES = {
    "cinebench_r23_single": Scale(480, 2380),
    "cinebench_r23_multi": Scale(1900, 180000),
    "geekbench_single": Scale(590, 3200),
    "geekbench_multi": Scale(1900, 92000),
    "passmark_single": Scale(300, 4730),
    "passmark_cpu_mark": Scale(210, 148000),
    "cinebench_2024_single": Scale(72, 144),
    "cinebench_2024_multi": Scale(483, 4321),
    "cinebench_r15_single": Scale(83, 346),
    "cinebench_r15_multi": Scale(149, 6536),
    "cinebench_r11_5_single": Scale(0.91, 4.0),
    "cinebench_r11_5_multi": Scale(1.0, 69),
    "cinebench_r10_single": Scale(541, 12522),
    "cinebench_r10_multi": Scale(865, 99662),
    "specint2006": Scale(11.4, 81.5),
    "specfp2006": Scale(10.3, 151),
    "dhrystone_mips": Scale(8.7, 9726),
    "whetstone_mflops": Scale(1, 200000),
    "superpi_1m_sec": Scale(5, 600, True, True),
}
GPU_SCALES = {
    "timespy_score": Scale(513, 34163),
    "timespy_extreme_score": Scale(173, 19460),
    "passmark_g3d_mark": Scale(3, 38073),
    "fp32_tflops": Scale(0.023, 81.72),
    "blender_score": Scale(97.45, 14972),
    "speedway_score": Scale(180, 10074),
    "octanebench_score": Scale(16, 1258),
}
CPU_CHAINS = {
    "single": ["cinebench_r23_single", "geekbench_single", "passmark_single", "cinebench_2024_single", "cinebench_r15_single", "cinebench_r11_5_single", "cinebench_r10_single", "specint2006", "dhrystone_mips", "superpi_1m_sec"],
    "multi": ["cinebench_r23_multi", "geekbench_multi", "passmark_cpu_mark", "cinebench_2024_multi", "cinebench_r15_multi", "cinebench_r11_5_multi", "cinebench_r10_multi", "specfp2006", "whetstone_mflops"],
}
GPU_CHAINS = {"graphics": ["timespy_score", "passmark_g3d_mark", "fp32_tflops", "blender_score", "timespy_extreme_score", "speedway_score", "octanebench_score"]}
CPU_WEIGHTS = {"single": 0.45, "multi": 0.55}
GPU_WEIGHTS = {"graphics": 1.0}
ERA_BANDS = ((0, 2005, "pre-2006"), (2006, 2009, "2006-2009"), (2010, 2013, "2010-2013"), (2014, 2016, "2014-2016"), (2017, 2019, "2017-2019"), (2020, 2021, "2020-2021"), (2022, 2023, "2022-2023"), (2024, 2999, "2024-2026"))
TIERS = ((95, "S"), (80, "A"), (60, "B"), (40, "C"), (20, "D"), (5, "E"), (0, "F"))


VERSION = "2.0.0"


def load_config(path: str, version: str = VERSION) -> dict:
    """A scoring configuration from JSON or, where a YAML reader is installed, YAML.

    Gives {"scales": {category: {benchmark: Scale}}, "chains", "weights", "era_bands",
    "tiers"}. A file that is no mapping or of another version is an error.
    """
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith((".yaml", ".yml")):
        import yaml

        raw = yaml.safe_load(text)
    else:
        raw = json.loads(text)
    if not isinstance(raw, dict):
        raise ValueError(f"{path} is not a mapping")
    if str(raw.get("algorithm_version")) != version:
        raise ValueError(f"{path} has version {raw.get('algorithm_version')!r}, not {version!r}")
    scale = lambda x: Scale(float(x["lo"]), float(x["hi"]), bool(x.get("log", False)), bool(x.get("invert", False)))
    return {
        "scales": {c: {n: scale(x) for n, x in group.items()} for c, group in raw["reference_scales"].items()},
        "chains": {c: {dim: [str(b) for b in chain] for dim, chain in dims.items()} for c, dims in raw["chains"].items()},
        "weights": {k: {n: float(w) for n, w in group.items()} for k, group in raw["weights"].items()},
        "era_bands": tuple((int(lo), int(hi), str(name)) for lo, hi, name in raw["era_bands"]),
        "tiers": tuple((float(least), str(name)) for least, name in raw["tiers"]),
    }


def py_round(c: Column, n: int = 1) -> Column:
    """Round the exact binary value half-even, as correctly rounded printing does.

    The value stands in the expression once: roundings are nested, and one that named it
    more often would grow with every level.
    """
    return F.call_function("format_number", c.cast("double"), F.lit("0." + "0" * n if n else "0")).cast("double")


def capability(c: Column, s: Scale) -> Column:
    """0 to 100 on a scale, one decimal; null for null, and for a scale without a span."""
    if s.hi <= s.lo or (s.log and s.lo <= 0):
        return F.lit(None).cast("double")
    x = F.least(F.greatest(c.cast("double"), F.lit(float(s.lo))), F.lit(float(s.hi)))
    lo, hi = F.lit(float(s.lo)), F.lit(float(s.hi))
    ratio = (F.ln(x) - F.ln(lo)) / (F.ln(hi) - F.ln(lo)) if s.log else (x - lo) / (hi - lo)
    if s.invert:
        ratio = 1.0 - ratio
    return F.when(c.isNotNull(), py_round(F.least(F.greatest(ratio * 100.0, F.lit(0.0)), F.lit(100.0)), 1))


def combine(parts: Sequence[tuple[Column, float]]) -> Column:
    """Weighted mean over the parts that are there; null if none has weight."""
    live = [(v, w) for v, w in parts if w != 0]
    if not live:
        return F.lit(None).cast("double")
    top = reduce(lambda a, b: a + b, [F.coalesce(v * w, F.lit(0.0)) for v, w in live])
    weight = reduce(lambda a, b: a + b, [F.when(v.isNotNull(), F.lit(float(w))).otherwise(F.lit(0.0)) for v, w in live])
    return F.when(weight > 0, py_round(top / F.nullif(weight, F.lit(0.0)), 1))


def era_band(date: Column, bands=ERA_BANDS) -> Column:
    """The first band that holds the year; null without a date or band."""
    y = F.year(date)
    return reduce(lambda acc, b: acc.when(y.between(b[0], b[1]), b[2]), bands[1:], F.when(y.between(bands[0][0], bands[0][1]), bands[0][2]))


def tier(percentile: Column, tiers=TIERS) -> Column:
    """The tier with the highest threshold reached; null for null."""
    return reduce(lambda acc, t: acc.when(percentile >= t[0], t[1]), tiers[1:], F.when(percentile >= tiers[0][0], tiers[0][1]))


def axis(chain: Sequence[tuple[Column, Scale, str]]) -> Column:
    """The first member of a chain with a capability, as struct (index, source)."""
    steps = F.array(*[F.struct(capability(c, s).alias("index"), F.lit(name).alias("source")) for c, s, name in chain])
    return F.get(F.filter(steps, lambda x: x["index"].isNotNull()), F.lit(0))
