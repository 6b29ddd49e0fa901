"""Rules for catalog documents: one row per document and broken rule.

Documents are read untyped, as JSON of any shape: a rule that asks for a number must see
that a text stands there. All rules of a document are worked out in one pass over it; only
duplicates and references need a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys a document of each category must have, bounds (inclusive), and allowed values.
REQUIRED = {
    "brand": ("slug", "name", "country", "categories", "source_urls"),
    "soc": ("slug", "name", "manufacturer", "release_date", "process_nm", "gpu_name"),
    "smartphone": ("slug", "name", "brand", "soc", "release_date", "ram_gb", "battery_mah", "weight_g", "os"),
    **dict.fromkeys(("tablet", "watch", "pda"), ("slug", "name", "brand", "release_date", "ram_gb", "battery_mah", "weight_g", "os", "source_urls", "verified")),
    "gpu": ("slug", "name", "manufacturer", "architecture", "release_date", "memory_gb", "memory_type", "memory_bus_bit", "base_clock_mhz", "boost_clock_mhz", "tdp_w", "pcie_version"),
    "cpu": ("slug", "name", "manufacturer", "release_date", "segment", "architecture", "cores", "threads"),
    "laptop": ("slug", "name", "brand", "release_date", "ram_gb", "os", "source_urls", "verified"),
    "monitor": ("slug", "name", "brand", "release_date", "size_inch", "resolution", "source_urls", "verified"),
    **dict.fromkeys(("game", "software", "website"), ("slug", "name", "source_urls", "verified")),
}
_MOBILE = {"ram_gb": (0.016, 64), "battery_mah": (50, 20000), "weight_g": (10, 2000), "msrp_usd": (10, 10000)}
RANGES = {
    "brand": {"founded_year": (1800, 2100)},
    "soc": {"process_nm": (1.0, 100.0)},
    "smartphone": {"ram_gb": (1, 64), "battery_mah": (500, 12000), "weight_g": (50, 500), "msrp_usd": (50, 5000)},
    **dict.fromkeys(("tablet", "watch", "pda"), _MOBILE),
    "gpu": {"memory_gb": (0.001, 512), "tdp_w": (1, 3000), "msrp_usd": (50, 100000)},
    "cpu": {"cores": (1, 512), "threads": (1, 1024), "msrp_usd": (20, 50000)},
    "laptop": {"ram_gb": (1, 256), "storage_gb": (1, 65536), "weight_g": (300, 6000), "msrp_usd": (50, 50000)},
    "monitor": {"size_inch": (5, 120), "refresh_hz": (24, 1000), "ppi": (20, 1000), "rating": (0, 5), "msrp_usd": (10, 50000)},
    "game": {"rating": (0, 5), "metacritic": (0, 100)},
}
BRAND_CATEGORIES = ("smartphone-oem", "soc-designer", "cpu-designer", "gpu-designer", "ip-licensor", "aib-partner", "pc-oem", "chipset-maker", "sub-brand", "defunct")
SEGMENTS = ("desktop", "laptop", "hedt", "server")
SLUG = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"
#: Categories whose release date is checked whenever the key is there, and when it is not null.
DATED, DATED_IF_KNOWN = ("soc", "smartphone", "tablet", "watch", "pda", "gpu", "cpu", "laptop", "monitor"), ("game", "software")
#: Categories in folders brand/year/base, and those of them that may lie flat.
FOLDERS, FLAT = ("smartphone", "tablet", "watch", "pda", "laptop", "monitor"), ("smartphone", "laptop", "monitor")
#: (category, field, target category, null allowed).
REFERENCES = (
    *((c, "manufacturer", "brand", False) for c in ("soc", "gpu", "cpu")),
    *((c, "brand", "brand", False) for c in FOLDERS),
    ("smartphone", "soc", "soc", False),
    *((c, "soc", "soc", True) for c in ("tablet", "watch", "pda")),
    ("laptop", "cpu", "cpu", True),
    ("laptop", "gpu", "gpu", True),
)


def kind(field: str) -> Column:
    """The type of a value in ``doc``: null without the key, VOID for null."""
    return F.schema_of_variant(F.try_variant_get("doc", f"$.{field}", "variant"))


def text(field: str) -> Column:
    """A value that is a text, else null."""
    return F.when(kind(field) == "STRING", F.try_variant_get("doc", f"$.{field}", "string"))


def number(field: str) -> Column:
    """A value that is a number (a truth value counts as 0 or 1), else null."""
    plain = F.when(kind(field).rlike("^(?:BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get("doc", f"$.{field}", "double"))
    return F.coalesce(plain, F.when(kind(field) == "BOOLEAN", F.try_variant_get("doc", f"$.{field}", "boolean").cast("int").cast("double")))


def texts(field: str) -> Column:
    """The members of a list, null where one is no text; null for what is no list."""
    many = F.try_variant_get("doc", f"$.{field}", "array<variant>")
    return F.when(kind(field).startswith("ARRAY"), F.transform(many, lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))))


def _by_category(table: dict[str, Column]) -> Column:
    return reduce(lambda acc, item: acc.when(F.col("category") == item[0], item[1]), list(table.items())[1:], F.when(F.col("category") == next(iter(table)), next(iter(table.values()))))


def _is(*categories: str) -> Column:
    return F.col("category").isin(*categories)


def broken_rules() -> Column:
    """Array of struct (rule, field) of the rules that one document breaks by itself."""
    c = F.col
    no = lambda b: ~F.coalesce(b, F.lit(False))
    yes = lambda b: F.coalesce(b, F.lit(False))
    found = []

    def rule(name: str, field: Column | str, broken: Column) -> None:
        found.append(F.when(broken, F.struct(F.lit(name).alias("rule"), (F.lit(field) if isinstance(field, str) else field).alias("field"))))

    wanted = _by_category({k: F.array(*[F.lit(x) for x in sorted(v)]) for k, v in REQUIRED.items()})
    missing = F.array_except(wanted, F.coalesce(F.json_object_keys("raw"), F.array().cast("array<string>")))
    rule("V01", F.array_join(missing, ","), yes(F.size(missing) > 0))
    rule("V02", "slug", no(text("slug").rlike(SLUG)))
    for field in sorted({f for v in RANGES.values() for f in v}):
        bounds = {k: v[field] for k, v in RANGES.items() if field in v}
        within = _by_category({k: number(field).between(float(lo), float(hi)) for k, (lo, hi) in bounds.items()})
        rule("V03", field, _is(*bounds) & yes(kind(field) != "VOID") & no(within))
    iso = text("release_date").rlike(r"^\d{4}-\d{2}-\d{2}$")
    rule("V04", "release_date", no(iso) & ((_is(*DATED) & kind("release_date").isNotNull()) | (_is(*DATED_IF_KNOWN) & yes(kind("release_date") != "VOID"))))
    rule("V04", "launch_date", _is("website") & yes(kind("launch_date") != "VOID") & no(text("launch_date").rlike(r"^\d{4}-\d{2}-\d{2}$")))
    urls = texts("source_urls")
    rule("V06", "source_urls", no((F.size(urls) > 0) & F.forall(urls, lambda u: yes(u.rlike("^https?://")))))
    # Folders: category/brand/year/base/slug.json.
    parts = F.split("path", "/")
    part = lambda i: F.get(parts, F.lit(i))
    year = F.when(kind("release_date") == "VOID", "None").otherwise(F.left(F.coalesce(F.try_variant_get("doc", "$.release_date", "string"), F.lit("")), F.lit(4)))
    own = lambda f: F.coalesce(text(f), F.lit(""))
    foldered = _is(*FOLDERS) & ~(_is(*FLAT) & (F.size(parts) == 4))
    deep = foldered & (F.size(parts) == 5)
    rule("V07", "path", foldered & (F.size(parts) != 5))
    rule("V07", "brand", deep & no(text("brand") == part(1)))
    rule("V07", "release_date", deep & (year != "") & (part(2) != year))
    rule("V07", "base_model_slug", deep & (own("base_model_slug") != "") & (own("base_model_slug") != part(3)))
    rule("V07", "slug", deep & no(part(4) == F.concat(text("slug"), F.lit(".json"))))
    rule("V08", "country", _is("brand") & yes(kind("country") != "VOID") & no(text("country").rlike("^[A-Z]{2}$")))
    cats = texts("categories")
    allowed = F.array(*[F.lit(x) for x in BRAND_CATEGORIES])
    listed = yes(F.size(cats) > 0)
    rule("V09", "categories", _is("brand") & ~listed)
    rule("V09", "categories:allowed", _is("brand") & listed & no(F.forall(cats, lambda x: yes(F.array_contains(allowed, x)))))
    rule("V09", "categories:twice", _is("brand") & listed & (F.size(F.array_distinct(cats)) != F.size(cats)))
    rule("V10", "path", _is("brand") & ((F.size(parts) != 3) | yes(part(1) != F.lower(text("country")))))
    rule("V12", "segment", _is("cpu") & no(text("segment").isin(*SEGMENTS)))
    return F.array_compact(F.array(*found))


def documents(docs: DataFrame) -> DataFrame:
    """Documents (path, category, raw) with the parsed ``doc``; null where raw is no JSON."""
    return docs.select("path", "category", "raw").withColumn("doc", F.try_parse_json(F.regexp_replace("raw", "^﻿", "")))


def duplicate_slugs(docs: DataFrame) -> DataFrame:
    """(path, category, slug, first_path) of documents whose slug an earlier path of the category has."""
    slugs = documents(docs).select("path", "category", text("slug").alias("slug")).where("slug is not null")
    # Counted per path, so a slug that a third of all documents bear is not sorted in one task.
    counted = slugs.groupBy("category", "slug", "path").agg(F.count(F.lit(1)).alias("_n"))
    first = slugs.groupBy("category", "slug").agg(F.min("path").alias("first_path"))
    more = F.col("_n") - F.when(F.col("path") == F.col("first_path"), 1).otherwise(0)
    twice = counted.join(first, ["category", "slug"]).where(more > 0)
    return twice.select("path", "category", "slug", "first_path", F.explode(F.sequence(F.lit(1), more.cast("int"))).alias("_k")).drop("_k")


def missing_references(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(path, field) of references to a slug that no document of the target category has.

    ``known`` (category, slug) adds slugs held elsewhere. A required reference may not be
    null or missing; an optional one may.
    """
    d = documents(docs).where("doc is not null")
    refs = F.array_compact(F.array(*[F.when(F.col("category") == c, F.struct(F.lit(f).alias("field"), F.lit(t).alias("target"), text(f).alias("slug"), F.lit(null).alias("null_ok"), F.coalesce(kind(f) == "VOID", F.lit(True)).alias("blank"))) for c, f, t, null in REFERENCES]))
    slugs = d.where(_is(*{t for _, _, t, _ in REFERENCES})).select(F.col("category").alias("target"), text("slug").alias("slug")).where("slug is not null")
    if known is not None:
        slugs = slugs.union(known.select("category", "slug"))
    asked = d.select("path", F.explode(refs).alias("r")).select("path", "r.*").where("not (null_ok and blank)")
    return asked.join(slugs.distinct().withColumn("there", F.lit(True)), ["target", "slug"], "left").where("there is null").select("path", "field")


def validate(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(path, rule, field) of every broken rule; rule S01 is a document that is no JSON."""
    d = documents(docs)
    own = d.where("doc is not null").select("path", F.explode(broken_rules()).alias("e")).select("path", "e.rule", "e.field")
    unread = d.where("doc is null").select("path", F.lit("S01").alias("rule"), F.lit("").alias("field"))
    twice = duplicate_slugs(docs).select("path", F.lit("V05").alias("rule"), F.lit("slug").alias("field"))
    return own.unionByName(unread).unionByName(twice).unionByName(missing_references(docs, known).select("path", F.lit("V11").alias("rule"), "field"))


def exit_code(errors: DataFrame) -> int:
    """1 if any rule is broken, else 0; stops at the first."""
    return int(not errors.isEmpty())
