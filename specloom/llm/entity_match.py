"""Matching entities across sources without keys.

Every record is reduced to attributes (maker, family, model code, suffix). The 2-grams of
maker and family become fixed 64-bit vectors; close pairs of vectors are found exactly
with multi-index Hamming hashing: the vector is cut into more bands than bits may differ,
so any close pair agrees in at least one band. Model code and suffix must agree in every
letter, so they are part of each band's key. Field-weighted Dice agreements give a score,
the score a confidence: isotonic regression, drawn through with straight lines, on all
close pairs whose entry names a maker in its address, which is evidence from outside the
name. Pairs with a confidence of CONFIDENT or more are matches.

Copies are folded first: all records with the same attributes are one class, pairs are
sought between classes, and members are joined back at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.llm.product_names import bit_vector, dice, maker_key, one_slip, with_product
from specloom.session import cut

#: Most bits in which the family vectors of a pair may differ. One slip of the pen changes
#: at most three 2-grams on either side, so six bits.
RADIUS = 7
BANDS = 8
#: Exponents of the fields' agreements in a pair's score; code and suffix agree by the key.
WEIGHTS = {"family": 0.5, "maker": 0.5}
#: Agreement taken for a maker that one side does not state.
UNSTATED = 0.8
#: What is left of the likeness of two families, or two makers, that are known to be others.
OTHER_FAMILY, OTHER_MAKER = 0.3, 0.25
CONFIDENT = 0.5
#: Pseudo pairs (score, matches, pairs) that stand where there is no evidence.
PRIOR = ((0.5, 0.0, 4.0), (0.85, 4.0, 4.0), (1.0, 4.0, 4.0))

KEYS = ("maker", "short", "address_maker", "family", "code", "suffix")


def attributes(df: DataFrame, id_col: str, name: Column, maker: Column | None = None, address_maker: Column | None = None) -> DataFrame:
    """(id, maker, short, address_maker, family, code, suffix); rows without a family or a code have no class."""
    none = F.lit(None).cast("string")
    rows = df.select(F.col(id_col).alias("id"), name.alias("name"), (none if maker is None else maker).alias("given"), (none if address_maker is None else address_maker).alias("address_maker"))
    # A written table: filters on what was parsed would else be pushed below and parse again.
    told = with_product(rows, F.col("name")).select(
        "id",
        F.coalesce("given", "p.maker").alias("maker"),
        (F.col("p.short") & F.col("given").isNull()).alias("short"),
        "address_maker",
        F.col("p.family").alias("family"),
        F.col("p.code").alias("code"),
        F.col("p.suffix").alias("suffix"),
    )
    return cut(told, "match-parsed").where("family <> ''")


def classes(attrs: DataFrame) -> DataFrame:
    """One row per set of equal attributes, numbered by their hash, with both vectors."""
    return (
        attrs.groupBy(*KEYS)
        .agg(F.count(F.lit(1)).alias("members"))
        .withColumn("class_id", F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\u0001")) for k in KEYS]))
        .withColumn("family_bits", bit_vector(F.col("family")))
        .withColumn("maker_bits", F.coalesce(bit_vector(F.col("maker")), F.lit(0).cast("bigint")))
    )


def band(bits: Column, i: Column | int) -> Column:
    """The i-th of BANDS slices of a vector."""
    width = 64 // BANDS
    return F.call_function("shiftrightunsigned", bits, (F.lit(i) * width if isinstance(i, int) else i * width).cast("int")).bitwiseAND(F.lit(2**width - 1).cast("bigint"))


def banded(df: DataFrame, side: str) -> DataFrame:
    """Eight narrow rows a class; code, suffix and band are one hash."""
    bands = F.array(*[band(F.col("family_bits"), i) for i in range(BANDS)])
    rows = df.select(F.col("class_id").alias(f"{side}_class_id"), F.col("family_bits").alias(f"{side}_bits"), F.xxhash64("code", "suffix").alias("_rest"), F.posexplode(bands).alias(f"{side}_band", "_slice"))
    return rows.select(f"{side}_class_id", f"{side}_bits", f"{side}_band", F.xxhash64("_rest", f"{side}_band", "_slice").alias("key"))


def close_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """All pairs of classes of equal code and suffix whose family vectors differ in at most RADIUS bits.

    Exact: RADIUS < BANDS, so one band agrees. A pair is kept at its first agreeing band
    only, which makes a distinct needless. Only numbers and vectors go through the search;
    attributes are joined to what it finds.
    """
    differ = F.col("a_bits").bitwiseXOR(F.col("b_bits"))
    first = reduce(lambda acc, i: acc.when(band(differ, i) == 0, F.lit(i)), range(1, BANDS), F.when(band(differ, 0) == 0, F.lit(0)))
    near = banded(left, "a").join(banded(right, "b"), "key").where((F.col("a_band") == F.col("b_band")) & (F.bit_count(differ) <= RADIUS) & (first == F.col("a_band"))).select("a_class_id", "b_class_id")
    named = lambda df, side: df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns if c != "members"])
    return near.join(named(left, "a"), "a_class_id").join(named(right, "b"), "b_class_id").where("a_code = b_code and a_suffix = b_suffix")


def likeness(a: Column, b: Column, a_bits: Column, b_bits: Column, other: float) -> Column:
    """Agreement of two words: 1 if equal, half and half of Dice one slip apart, else a part of it."""
    d = dice(a_bits, b_bits)
    return F.when(a == b, F.lit(1.0)).when(one_slip(a, b), 0.5 + 0.5 * d).otherwise(other * d)


def abbreviated(full: Column, short: Column) -> Column:
    """1 for an abbreviation, 0.6 where a slip in one is likely (same first letter, its letters are in the head), else 0."""
    inside = F.size(F.array_except(F.split(short, ""), F.split(F.substring(full, 1, 4), ""))) == 0
    return F.when(full.startswith(short), F.lit(1.0)).when((F.substring(full, 1, 1) == F.substring(short, 1, 1)) & inside, F.lit(0.6)).otherwise(F.lit(0.0))


def scored(pairs: DataFrame) -> DataFrame:
    """The ids of pairs with ``told`` (score of the names alone), ``score`` (with the address) and ``address_agrees``.

    A right family that is spelled like another known left family is that family, however
    near; a maker in the address outweighs an unstated one and cannot be outvoted.
    """
    c = F.col
    family = F.when((c("a_family") != c("b_family")) & c("b_known"), OTHER_FAMILY * dice(c("a_family_bits"), c("b_family_bits"))).otherwise(likeness(c("a_family"), c("b_family"), c("a_family_bits"), c("b_family_bits"), OTHER_FAMILY))
    maker = F.when(c("b_short"), abbreviated(c("a_maker"), c("b_maker"))).otherwise(likeness(c("a_maker"), c("b_maker"), c("a_maker_bits"), c("b_maker_bits"), OTHER_MAKER))
    stated = F.when(c("a_maker").isNotNull() & c("b_maker").isNotNull(), maker)
    address = F.when(c("a_maker") == c("b_address_maker"), 1.0).when(one_slip(c("a_maker"), c("b_address_maker")), 0.75).otherwise(F.when(c("a_maker").isNotNull() & c("b_address_maker").isNotNull(), 0.1))
    score = lambda of: F.round(F.pow("_family", F.lit(WEIGHTS["family"])) * F.pow(of, F.lit(WEIGHTS["maker"])), 4)
    out = pairs.select("a_class_id", "b_class_id", family.alias("_family"), stated.alias("_maker"), address.alias("_address"))
    none = F.lit(UNSTATED)
    return out.select("a_class_id", "b_class_id", score(F.coalesce("_maker", none)).alias("told"), score(F.coalesce(F.least("_maker", "_address"), none)).alias("score"), (F.col("_address") == 1.0).alias("address_agrees"))


def isotonic(points: list[tuple[float, float, float]]) -> list[tuple[float, float]]:
    """Pool adjacent violators over (x, positives, total): non-decreasing rates by x."""
    blocks: list[list[float]] = []
    for x, pos, n in sorted(points):
        blocks.append([x, pos, n])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            _, p, m = blocks.pop()
            blocks[-1][1] += p
            blocks[-1][2] += m
    # One half success and failure more in each block keeps rates off 0 and 1.
    return [(x, round((p + 0.5) / (n + 1.0), 4)) for x, p, n in blocks]


def curve_points(points: list[tuple[float, float, float]]) -> list[tuple[float, float]]:
    """Isotonic rates at the mean score of each block, over (mean score, matches, pairs) of bins."""
    merged = [(x, y) for x, y in isotonic(points)]
    out = []
    for i, (start, rate) in enumerate(merged):
        inside = [(x, n) for x, _, n in points if x >= start and (i + 1 == len(merged) or x < merged[i + 1][0])]
        out.append((sum(x * n for x, n in inside) / sum(n for _, n in inside), rate))
    return out


def calibration(pairs: DataFrame, bins: int = 50) -> list[tuple[float, float]]:
    """Confidence by score, from all close pairs whose entry states its maker in the address.

    At most ``bins`` + 1 counted bins come to the driver, whatever the input.
    """
    rows = (
        pairs.where("address_agrees is not null")
        .groupBy(F.floor(F.col("told") * bins).alias("bin"))
        .agg(F.avg("told").alias("x"), F.sum(F.col("address_agrees").cast("double")).alias("p"), F.count(F.lit(1)).cast("double").alias("n"))
        .collect()
    )
    return curve_points([*PRIOR, *[(r["x"], r["p"], r["n"]) for r in rows]])


def confidence(score: Column, curve: list[tuple[float, float]]) -> Column:
    """Straight lines between the points of a calibration curve, level beyond its ends."""
    out = F.when(score <= curve[0][0], F.lit(curve[0][1]))
    for (x0, y0), (x1, y1) in zip(curve, curve[1:]):
        out = out.when(score <= x1, y0 + (y1 - y0) / (x1 - x0) * (score - x0))
    return out.otherwise(F.lit(curve[-1][1]))


def match(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Matches between classes of both sides, and the classes of each row of either side.

    ``left`` and ``right`` are as ``attributes`` gives them. Rows without a parsed name are
    in no class and match nothing; nulls, copies and ties are no special cases. Without a
    single entry that names a maker in its address the curve is that of the pseudo pairs.
    """
    lc = cut(classes(left), "match-left")
    known = lc.select("family").distinct().withColumn("known", F.lit(True))
    rc = cut(classes(right).join(known, "family", "left").withColumn("known", F.coalesce("known", F.lit(False))), "match-right")
    pairs = cut(scored(close_pairs(lc, rc)), "match-pairs")
    sure = confidence(F.col("score"), calibration(pairs))
    kept = pairs.select("a_class_id", "b_class_id", "score", F.round(sure, 4).alias("confidence")).where(F.col("confidence") >= CONFIDENT)
    number = F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\u0001")) for k in KEYS])
    return kept, left.select("id", number.alias("a_class_id")), right.select("id", number.alias("b_class_id"))


def point_attributes(points: DataFrame) -> DataFrame:
    """Attributes of coverage points: the maker from its column, else from the source's name, else from the name."""
    from_source = F.nullif(F.regexp_extract(F.col("source"), r":([a-z]+)_", 1), F.lit(""))
    return attributes(points, "point_id", F.coalesce("name", F.regexp_replace("slug", "-", " ")), F.coalesce(maker_key(F.col("manufacturer")), maker_key(from_source)))


def candidate_attributes(candidates: DataFrame) -> DataFrame:
    """Attributes of upstream entries: the title, and the maker named in an address like host/maker/number."""
    address = F.nullif(F.regexp_extract(F.col("url"), r"://[^/]+/([a-z]{2,})/\d+", 1), F.lit(""))
    return attributes(candidates, "candidate_id", F.col("title"), None, maker_key(address))


def match_points(points: DataFrame, candidates: DataFrame) -> DataFrame:
    """(point_id, candidate_id, confidence) of all matches."""
    kept, left, right = match(point_attributes(points), candidate_attributes(candidates))
    return (
        kept.join(left, "a_class_id").withColumnRenamed("id", "point_id").join(right, "b_class_id").select("point_id", F.col("id").alias("candidate_id"), "confidence")
    )
