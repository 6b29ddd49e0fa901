"""Quantities recorded in different units.

A value's unit is read from its text or, where none is written, found by physical
identities: the quantity lies about the field's centre, a cache is so many slices times
the size of one, and a boost clock is the base clock times a factor a little over one. A
base and a boost clock are solved together: of all combinations of their units (and of
readings of a comma) the one with the least sum of absolute log residuals over all
identities holds; a value whose best combination with another unit is nearly as good is
flagged as not unique.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.session import cut


#: Units of each dimension with their size in the dimension's smallest unit.
CLOCK = {"hz": 1.0, "khz": 1e3, "mhz": 1e6, "ghz": 1e9}
CACHE = {"b": 1.0, "kb": 1024.0, "mb": 1024.0**2, "gb": 1024.0**3}


@dataclass(frozen=True)
class Field:
    """A field, its dimension, its own unit and a centre for tables without written units."""

    name: str
    units: dict[str, float]
    unit: str
    centre: float


FIELDS = {f.name: f for f in (Field("base_clock_ghz", CLOCK, "ghz", 2.9e9), Field("base_clock_mhz", CLOCK, "mhz", 1.4e9), Field("l3_cache_mb", CACHE, "mb", 20 * 1024.0**2))}

#: Boost clocks are about this factor over base clocks.
BOOST_RATIO_LOG = math.log(1.3)
#: Two combinations closer than this in log residual are not told apart.
MARGIN = 0.7

_UNIT = r"(?<![a-z])(gigahertz|ghz|megahertz|mhz|kilohertz|khz|hertz|hz|gigabytes?|gib|gb|g|megabytes?|mib|mb|m|kilobytes?|kib|kb|k|bytes?|b)(?![a-z])"
_NUMBER = r"\d[\d.,' ]*"


def clean(c: Column) -> Column:
    """Lower case, plain spaces, no footnotes, no words that say nothing about the value."""
    t = F.regexp_replace(F.translate(F.lower(c), "\u00a0\u2009\u202f\t~’′`", "     '''"), r"\[[^\]]*\]|\bl[123]\b:?|\bshared\b", " ")
    return F.trim(F.regexp_replace(t, " +", " "))


def _group(c: Column, pattern: str, group: int = 1) -> Column:
    """A regex group that is never empty where it matches; null elsewhere."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def base_part(c: Column) -> Column:
    """The part of a cleaned text that states the base value, when a boost is stated too."""
    two = c.rlike("boost|turbo|up to|base|max")
    found = F.coalesce(
        _group(c, r"(?:boost|turbo)\s*[,;]\s*(.+?)\s*base$"),
        _group(c, r"base:?\s*(.+?)\s*[,;]\s*(?:boost|turbo|max)"),
        _group(c, r"^(.+?)\s*\((?:up to|boost|turbo|max)"),
        F.trim(F.regexp_replace(c, r"\(?\bbase\b\)?:?", " ")),
    )
    return F.when(two, found).otherwise(c)


def parse_readings(df: DataFrame, text_col: str = "value_text") -> DataFrame:
    """Adds ``_unit`` (in one spelling, null where none is written) and the readings ``_n1``, ``_n2``.

    A number is times the count of slices. A comma before three digits parts thousands in
    the first reading and decimals in the second; which holds is settled by the residuals.
    Without a positive number both are null. Each step is a column, worked out once.
    """
    c = F.col
    letter = F.substring("_word", 1, 1)
    unit = F.when(c("_word").rlike("h(ert)?z$"), F.when(letter == "h", "hz").otherwise(F.concat(letter, F.lit("hz")))).when(c("_word") != "", F.when(letter == "b", "b").otherwise(F.concat(letter, F.lit("b"))))
    slices = F.coalesce(F.regexp_extract("_part", r"(\d+)\s*[x×]\s*\d", 1).try_cast("double"), F.lit(1.0))
    digits = F.regexp_replace(F.regexp_replace(F.regexp_extract("_body", f"({_NUMBER})", 1), r"[' ]", ""), r"[.,]+$", "")
    comma = c("_digits").contains(",")
    thousands = c("_digits").rlike(r"^\d{1,3}(,\d{3})+(\.\d+)?$")
    n1 = F.when(~comma, c("_digits").try_cast("double")).when(thousands, F.regexp_replace("_digits", ",", "").try_cast("double"))
    n2 = F.when(comma & c("_digits").rlike(r"^\d+,\d+$"), F.regexp_replace("_digits", ",", ".").try_cast("double"))
    positive = lambda x: F.when(x > 0, x)
    return (
        df.withColumn("_clean", clean(c(text_col)))
        .withColumn("_part", base_part(c("_clean")))
        .withColumn("_word", F.regexp_extract("_part", _UNIT, 1))
        .withColumn("_body", F.when(c("_part").rlike("[x×]"), F.regexp_replace("_part", r"^.*?\d+\s*[x×]\s*(?=\d)", "")).otherwise(c("_part")))
        .withColumn("_digits", digits)
        .withColumn("_slices", slices)
        .withColumn("_unit", unit)
        .withColumn("_n1", positive(n1 * c("_slices")))
        .withColumn("_n2", positive(n2 * c("_slices")))
        .drop("_clean", "_part", "_word", "_body", "_digits", "_slices")
    )


def solve(df: DataFrame, units: dict[str, float]) -> DataFrame:
    """Adds ``field_unit``, ``stated_unit``, ``value`` (in it) and ``unique_solution``.

    For rows of fields of one dimension, with spec_field, _unit, _n1, _n2, boost and
    _centre. For every unit of the value, the reading nearer to the centre and the boost's
    unit that fits both the centre and the value best make its residual. All of it is plain
    arithmetic. A row without a combination has null.
    """
    c, names = F.col, list(units)
    fields = [f for f in FIELDS.values() if f.units is units]
    own = lambda of: reduce(lambda acc, f: acc.when(c("spec_field") == f.name, F.lit(of(f))), fields[1:], F.when(c("spec_field") == fields[0].name, F.lit(of(fields[0]))))
    log = {u: math.log(size) for u, size in units.items()}
    mid = F.coalesce("_centre", own(lambda f: math.log(f.centre)))
    df = df.withColumns({"field_unit": own(lambda f: f.unit), "_own": own(lambda f: f.units[f.unit]), "_d1": F.ln("_n1") - mid, "_d2": F.ln("_n2") - mid, "_lb": (F.when(c("boost") > 0, F.ln("boost") - BOOST_RATIO_LOG - mid) if units is CLOCK else F.lit(None).cast("double"))})
    # The value in each unit (its reading nearer to the centre) and the boost in each, off their centres.
    df = df.withColumns({f"_v_{u}": F.when(c("_d1").isNull() | (F.abs(c("_d2") + x) < F.abs(c("_d1") + x)), c("_d2") + x).otherwise(c("_d1") + x) for u, x in log.items()})
    if units is CLOCK:
        df = df.withColumns({f"_b_{u}": c("_lb") + x for u, x in log.items()})
        pull = {u: F.coalesce(F.least(*[F.abs(c(f"_b_{w}")) + F.abs(c(f"_b_{w}") - c(f"_v_{u}")) for w in names]), F.lit(0.0)) for u in names}
    else:
        pull = dict.fromkeys(names, F.lit(0.0))
    # Residuals in order, the unit's number settles ties; a unit that cannot be is infinitely far.
    cost = [F.coalesce(F.when(c("_unit").isNull() | (c("_unit") == u), F.abs(c(f"_v_{u}")) + pull[u]), F.lit(float("inf"))) for u in names]
    df = df.withColumn("_s", F.sort_array(F.array(*[F.struct(x.alias("cost"), F.lit(i).alias("i")) for i, x in enumerate(cost)])))
    best, rival = c("_s")[0], c("_s")[1]
    pick = lambda values: F.when(best["cost"] < float("inf"), F.get(F.array(*[F.lit(v) for v in values]), best["i"]))
    df = df.withColumns({"stated_unit": pick(names), "_size": pick(units.values()), "_log": pick(log.values()), "_apart": rival["cost"] - best["cost"] >= MARGIN})
    first, second = F.abs(c("_d1") + c("_log")), F.abs(c("_d2") + c("_log"))
    number = F.when(F.coalesce(second < first, c("_d1").isNull()), c("_n2")).otherwise(c("_n1"))
    return df.withColumns({"value": number * c("_size") / c("_own"), "unique_solution": F.coalesce("_apart", F.lit(True)) & F.coalesce(F.abs(first - second) >= MARGIN, F.lit(True))})


def centres(parsed: DataFrame) -> DataFrame:
    """Per field the median log quantity over values whose unit is written and whose number is plain."""
    size = reduce(lambda acc, u: acc.when(F.col("_unit") == u[0], F.lit(math.log(u[1]))), [*CLOCK.items(), *CACHE.items()][1:], F.when(F.col("_unit") == "hz", F.lit(0.0)))
    return (
        parsed.where("_unit is not null and _n1 is not null and _n2 is null").where(F.col("spec_field").isin(*FIELDS))
        .groupBy(F.col("spec_field").alias("_field"))
        .agg(F.percentile_approx(F.ln("_n1") + size, 0.5, 1000).alias("_centre"))
    )


def standardise(sources: list[tuple[str, DataFrame]], spec: DataFrame) -> DataFrame:
    """All values in the unit of their field's name.

    ``sources`` are (table name, counting rows with id and any of the fields, and a column
    ``boost`` where one is stated); ``spec`` has reading_id, spec_field, value_text. Gives
    src_table, row_id, spec_field, stated_unit, field_unit, value, unique_solution. Nulls,
    fillers, zero and negative numbers and unknown fields have no value and give no row.
    """
    none = F.lit(None).cast("double")
    # A written table: filters on what was parsed would else be pushed below and parse again.
    texts = cut(parse_readings(spec.select(F.lit("spec_readings").alias("src_table"), F.col("reading_id").cast("bigint").alias("row_id"), "spec_field", "value_text")).drop("value_text").withColumn("boost", none), "units-parsed")
    middle = centres(texts)
    rows = texts.where(F.col("_n1").isNotNull() | F.col("_n2").isNotNull())
    for name, df in sources:
        for f in FIELDS.values():
            if f.name in df.columns:
                rows = rows.unionByName(
                    df.where(F.col(f.name) > 0).select(
                        F.lit(name).alias("src_table"), F.col("id").cast("bigint").alias("row_id"), F.lit(f.name).alias("spec_field"), F.lit(None).cast("string").alias("_unit"),
                        F.col(f.name).cast("double").alias("_n1"), none.alias("_n2"), (F.col("boost").cast("double") if "boost" in df.columns else none).alias("boost"),
                    )
                )
    # At most one row per field of FIELDS.
    joined = rows.join(F.broadcast(middle), F.col("spec_field") == F.col("_field"), "left")
    out = None
    for units in (CLOCK, CACHE):
        known = F.col("spec_field").isin(*[f.name for f in FIELDS.values() if f.units is units]) & (F.col("_unit").isNull() | F.col("_unit").isin(*units))
        one = solve(joined.where(known), units).select("src_table", "row_id", "spec_field", "stated_unit", "field_unit", "value", "unique_solution")
        out = one if out is None else out.unionByName(one)
    return out
