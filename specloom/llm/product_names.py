"""Product names as written by many hands, parsed into attributes with column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.functions.text import fold_ascii

# Words around a product name that are no part of it.
KIND_WORDS = ("mobile platform", "system on a chip", "system-on-a-chip", "graphics card", "processor", "smartphone", "chipset", "phone", "tablet", "cpu", "gpu", "apu", "soc", "dual sim", "handset")
CORPORATE_WORDS = ("technologies", "technology", "electronics", "devices", "mobile", "group", "corporation", "company", "corp", "inc", "ltd", "llc", "gmbh", "co")
BY_WORDS = ("by", "von", "de", "from", "par", "di", "por")
NOT_A_PRODUCT = r"^list of\b|\((company|product line|brand|manufacturer|disambiguation)\)|\b(series|lineup|product line)\b"


def folded(c: Column) -> Column:
    """Lower-case ASCII without trade marks, footnotes, memory sizes, clocks, bus and process notes."""
    # Underscores are blanks before any rule looks for the ends of words.
    t = F.lower(fold_ascii(F.regexp_replace(F.regexp_replace(c, "[®™©]", ""), r"[_\s]+", " ")))
    t = F.regexp_replace(t, r"\((?:r|tm|c)\)|\[[^\]]*\]", " ")
    t = F.regexp_replace(t, r"/\s?pci-?e?\b.*$|[@,]\s*\d+(?:[.,]\d+)?\s*[gmk]hz\b", " ")
    t = F.regexp_replace(t, r"\(?\b\d+(?:[.,]\d+)?\s?(?:gb|tb|mb|nm|ghz|mhz)\b\)?", " ")
    # "5G" and "2nd Gen" may be written onto the number; ordinals have one form.
    t = F.regexp_replace(t, r"(?<=\d)5g\b", " 5g")
    t = F.regexp_replace(t, r"(?<=\d)?([1-9])\s?(?:st|nd|rd|th)[\s-]?gen\b", " gen $1 ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def without_kind(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\(?\b(?:" + "|".join(KIND_WORDS) + r")\b\)?", " "), r"\s+", " "))


def with_product(df: DataFrame, text: Column, out: str = "p") -> DataFrame:
    """Adds the attributes of a name: struct (maker, short, family, code, suffix), null parts where absent.

    ``code`` is the model number with the letter before it, ``suffix`` all that follows it
    without blanks (a plus sign is the word plus). A number of three to five digits is the
    model's; without one the first number is. ``family`` is the last word before it, lone
    digits between the two belong to the code. A name without any digit is all family, with
    an empty code. ``maker`` is what stands before the family, in brackets, or after a word
    like "by"; ``short`` marks an abbreviated maker. A null, a text without letters or digits
    and a name of something else (a company, a list) give a null struct.
    Each step is a column of its own, so no step is worked out twice.
    """
    tail = r"(?:\(([a-z][a-z. ]+)\)|\s(?:" + "|".join(BY_WORDS) + r")\s+([a-z][a-z. ]+))\s*$"
    shape = r"^\s*(.*?)\s?\b(?:([a-z])\s?)?(\d{3,5})(?!\d)\s*(.*)$"
    lesser = r"^\s*(.*?)\s?\b(?:([a-z])\s?)?(\d+)(?!\d)\s*(.*)$"
    corporate = r"\b(?:" + "|".join(CORPORATE_WORDS) + r")\b\.?"
    c = F.col
    n = F.size("_words")
    part = lambda g: F.when(c("_kind") == 1, F.regexp_extract("_body", shape, g)).when(c("_kind") == 2, F.regexp_extract("_body", lesser, g))
    return (
        df.withColumn("_t", without_kind(folded(text)))
        .withColumn("_tail", F.regexp_extract(F.concat(F.regexp_extract("_t", tail, 1), F.regexp_extract("_t", tail, 2)), r"^\s*([a-z.]+)", 1))
        .withColumn("_body", F.regexp_replace(F.regexp_replace(F.regexp_replace("_t", tail, " "), r"\+", " plus "), r"[^a-z0-9.]+", " "))
        .withColumn("_kind", F.when(c("_body").rlike(r"\b[a-z]?\s?\d{3,5}(?!\d)"), 1).when(c("_body").rlike(r"\b[a-z]?\d"), 2).when(c("_body").rlike("[a-z]"), 3))
        .withColumn("_words", F.filter(F.split(F.regexp_replace(F.coalesce(part(1), c("_body")), corporate, " "), r"\s+"), lambda w: w != ""))
        # Numbers between the family and the model's number.
        .withColumn("_between", F.when(c("_kind") < 3, F.regexp_replace(F.regexp_extract(F.array_join("_words", " "), r"((?:\s[0-9.]+)+)$", 1), r"[^0-9]+", "-")))
        .withColumn("_words", F.when(c("_between") != "", F.filter("_words", lambda w: ~w.rlike(r"^[0-9.]+$"))).otherwise(c("_words")))
        .withColumn("_first", F.when(n > 1, F.get("_words", F.lit(0))).when(c("_tail") != "", c("_tail")))
        .withColumn(
            out,
            F.when(
                c("_kind").isNotNull() & ~c("_t").rlike(NOT_A_PRODUCT),
                F.struct(
                    F.nullif(F.regexp_replace("_first", "[^a-z]", ""), F.lit("")).alias("maker"),
                    F.coalesce(c("_first").endswith("."), F.lit(False)).alias("short"),
                    F.when(c("_kind") == 3, F.regexp_replace(F.array_join(F.when(n > 1, F.slice("_words", 2, F.greatest(n, F.lit(1)))).otherwise(c("_words")), ""), "[^a-z]", "")).otherwise(F.regexp_replace(F.get("_words", n - 1), "[^a-z]", "")).alias("family"),
                    F.when(c("_kind") == 3, "").otherwise(F.concat(F.when(c("_between") != "", F.concat(F.substr("_between", F.lit(2)), F.lit("-"))).otherwise(""), part(2), part(3))).alias("code"),
                    F.when(c("_kind") == 3, "").otherwise(F.regexp_replace(part(4), "[^a-z0-9]", "")).alias("suffix"),
                ),
            ),
        )
        .drop("_t", "_tail", "_body", "_kind", "_words", "_between", "_first")
    )


def maker_key(c: Column) -> Column:
    """First word of a maker's name, folded; null when blank."""
    return F.nullif(F.regexp_extract(F.lower(fold_ascii(c)), r"([a-z]+)", 1), F.lit(""))


def bigrams(c: Column) -> Column:
    """The 2-grams of a word with its edges marked."""
    s = F.concat(F.lit("^"), c, F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - 1, F.lit(1))), lambda i: F.substr(s, i, F.lit(2)))


def bit_vector(c: Column) -> Column:
    """The 2-grams of a word as 64 bits: each sets the bit its hash names. Null gives 0."""
    one = F.lit(1).cast("bigint")
    bits = F.aggregate(bigrams(c), F.lit(0).cast("bigint"), lambda acc, g: acc.bitwiseOR(F.call_function("shiftleft", one, F.pmod(F.xxhash64(g), F.lit(64)).cast("int"))))
    return F.coalesce(bits, F.lit(0).cast("bigint"))


def dice(a: Column, b: Column) -> Column:
    """Dice similarity of two bit vectors; two empty ones are alike."""
    total = F.bit_count(a) + F.bit_count(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.bit_count(a.bitwiseAND(b)) / total)


def one_slip(a: Column, b: Column) -> Column:
    """Equal, one letter more, less or other, or two neighbouring letters swapped."""
    d = F.levenshtein(a, b, 2)
    letters = lambda x: F.array_sort(F.split(x, ""))
    return (d >= 0) & ((d <= 1) | ((F.length(a) == F.length(b)) & (letters(a) == letters(b))))
