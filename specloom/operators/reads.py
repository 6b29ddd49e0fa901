"""Lists and details of the catalog: filters by slug, allowed orders, pages, references, projections."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = "/v1"


@dataclass(frozen=True)
class Resource:
    """What a list may be ordered by and filtered with.

    ``filters`` maps a parameter to its column and, where the parameter is a slug of another
    resource, to that resource.
    """

    sort: tuple[str, ...] = ()
    filters: dict[str, tuple[str, str | None]] = field(default_factory=dict)


# The parameters that each list takes.
_DEVICE = ("name", "release_date", "msrp_usd")
_BRAND = {"brand": ("brand_id", "brands")}
_MODEL = {"base_model_slug": ("base_model_slug", None)}
_MOBILE = Resource(_DEVICE, {**_BRAND, "soc": ("soc_id", "socs"), **_MODEL})
RESOURCES = {
    "brands": Resource(),
    "socs": Resource(),
    "gpus": Resource(),
    "cpus": Resource((), {"segment": ("segment", None)}),
    "smartphones": Resource(_DEVICE, {**_BRAND, "soc": ("soc_id", "socs")}),
    "tablets": _MOBILE,
    "watches": _MOBILE,
    "pdas": _MOBILE,
    "laptops": Resource(_DEVICE, {**_BRAND, "cpu": ("cpu_id", "cpus"), "gpu": ("gpu_id", "gpus"), **_MODEL}),
    "monitors": Resource((*_DEVICE, "size_inch", "refresh_hz"), {**_BRAND, "panel_type": ("panel_type", None), **_MODEL}),
    "games": Resource(("name", "release_date", "rating", "metacritic")),
    "software": Resource(("name", "release_date")),
    "websites": Resource(("name", "launch_date")),
}


def url(resource: str, slug: Column | str) -> Column:
    return F.concat(F.lit(f"{PREFIX}/{resource}/"), F.col(slug) if isinstance(slug, str) else slug)


def ref(resource: str, prefix: str) -> list[Column]:
    """The embedded reference of a joined row: slug, name and address under ``prefix``."""
    return [F.col(f"{prefix}_slug"), F.col(f"{prefix}_name"), url(resource, f"{prefix}_slug").alias(f"{prefix}_url")]


def named(df: DataFrame, prefix: str, *more: str) -> DataFrame:
    """A parent's id, slug and name for a join, as ``{prefix}_id`` and so on."""
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in ("id", "slug", "name", *more)])


def order_by(resource: str, sort: str | None = None) -> list[Column]:
    """The order of a list: by name, or by an allowed field ("-" in front: descending).

    Nulls come first ascending and last descending; slug and id make the order total. A
    field that is not allowed is an error.
    """
    last = [F.col("slug"), F.col("id")]
    if not sort:
        return [F.col("name").asc_nulls_first(), *last]
    name = sort.removeprefix("-")
    if name not in RESOURCES[resource].sort:
        raise ValueError(f"Cannot sort by '{name}'")
    return [F.col(name).desc_nulls_last() if sort.startswith("-") else F.col(name).asc_nulls_first(), *last]


def matching(rows: DataFrame, resource: str, parents: dict[str, DataFrame], **params: str | None) -> DataFrame:
    """Rows that all given parameters allow; a slug that no parent has leaves none.

    A slug that several parents bear stands for the one with the lowest id.
    """
    for name, value in params.items():
        if value is None:
            continue
        column, parent = RESOURCES[resource].filters[name]
        if parent is None:
            rows = rows.where(F.col(column) == value)
        else:
            # One row, null without a match.
            chosen = parents[parent].where(F.col("slug") == value).agg(F.min("id").alias("_id"))
            rows = rows.join(F.broadcast(chosen), F.col(column) == F.col("_id"), "left_semi")
    return rows


def count_of(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("count"))


def list_page(rows: DataFrame, resource: str, sort: str | None = None, offset: int = 0, limit: int = 20) -> DataFrame:
    """(slug, name, url) of one page; limit 1 to 100, offset 0 or more."""
    if not 1 <= limit <= 100 or offset < 0:
        raise ValueError("limit must be 1 to 100 and offset 0 or more")
    return rows.orderBy(*order_by(resource, sort)).offset(offset).limit(limit).select("slug", "name", url(resource, "slug").alias("url"))


def all_pages(rows: DataFrame, resource: str, limit: int = 100) -> Iterator[list]:
    """The pages of a list one after the other until none follows, for consumers that take a page at a time."""
    count, offset = count_of(rows).first()["count"], 0
    while offset < count:
        yield list_page(rows, resource, None, offset, limit).collect()
        offset += limit


def lookup(rows: DataFrame, slug: str) -> DataFrame:
    """The row of a slug (of several the lowest id), or none."""
    return rows.where(F.col("slug") == slug).orderBy("id").limit(1)


def collections(exclude: list[str] | None = None) -> list[str]:
    """All collections but some, in their order; an unknown name is an error."""
    unknown = sorted(set(exclude or ()) - set(RESOURCES))
    if unknown:
        raise ValueError(f"unknown collection(s) {unknown}; valid names: {', '.join(RESOURCES)}")
    return [r for r in RESOURCES if r not in set(exclude or ())]


# ---- Details. Raw benchmark columns stay out; nested parts are columns as they are.

_SOC = ("release_date", "process_nm", "transistors_billion", "cpu_config", "gpu_name", "gpu_cores", "gpu_clock_mhz", "npu_tops", "modem", "verified", "source_urls")
_GPU = ("architecture", "release_date", "msrp_usd", "cuda_cores", "stream_processors", "rt_cores", "tensor_cores", "memory_gb", "memory_type", "memory_bus_bit", "memory_bandwidth_gbps", "base_clock_mhz", "boost_clock_mhz", "tdp_w", "pcie_version", "fp32_tflops", "blender_score", "verified", "source_urls")
_CPU = ("release_date", "segment", "architecture", "socket", "process_node", "cores", "threads", "p_cores", "e_cores", "base_clock_ghz", "boost_clock_ghz", "l3_cache_mb", "tdp_w", "max_tdp_w", "integrated_graphics", "memory_support", "msrp_usd", "verified", "source_urls")
_PHONE = ("base_model_slug", "release_date", "msrp_usd", "ram_gb", "storage_options_gb", "variant", "display", "cameras", "battery_mah", "charging_wired_w", "charging_wireless_w", "weight_g", "dimensions", "ip_rating", "os", "os_version", "connectivity", "image_url", "images", "verified", "source_urls")
_LAPTOP = ("base_model_slug", "release_date", "msrp_usd", "device_category", "cpu_name", "gpu_name", "gpu_type", "ram_gb", "storage_gb", "display", "weight_g", "os", "os_version", "variant", "image_url", "verified", "source_urls")
_MONITOR = ("base_model_slug", "release_date", "msrp_usd", "size_inch", "resolution", "aspect_ratio", "refresh_hz", "panel_type", "curvature", "hdr", "ppi", "features", "rating", "variant", "image_url", "verified", "source_urls")
_GAME = ("release_date", "rating", "rating_count", "metacritic", "playtime_hours", "platforms", "genres", "stores", "developers", "publishers", "tags", "esrb_rating", "background_image", "verified", "source_urls")
_SOFTWARE = ("release_date", "developers", "publishers", "operating_systems", "programming_languages", "licenses", "genres", "verified", "source_urls")
_WEBSITE = ("homepage_url", "launch_date", "owners", "languages", "verified", "source_urls")
_BRAND_COLUMNS = ("country", "founded_year", "logo_url", "website", "source_urls", "description_en", "description_ko")
DETAIL = {
    "brands": _BRAND_COLUMNS, "socs": _SOC, "gpus": _GPU, "cpus": _CPU, "smartphones": _PHONE, "tablets": _PHONE, "watches": _PHONE, "pdas": _PHONE,
    "laptops": _LAPTOP, "monitors": _MONITOR, "games": _GAME, "software": _SOFTWARE, "websites": _WEBSITE,
}


def detail(rows: DataFrame, resource: str, parents: dict[str, DataFrame]) -> DataFrame:
    """Details of all rows of a resource, with the references it embeds.

    Columns that the rows lack are left out. A row whose required parent is missing has no
    detail; optional parents may be missing. ``parents`` has brands, and socs, cpus or gpus
    where the resource refers to them.
    """
    own = [c for c in DETAIL[resource] if c in rows.columns]
    refs: list[Column] = []
    brands = parents.get("brands")
    if resource in ("socs", "gpus", "cpus"):
        rows = rows.join(named(brands, "manufacturer"), "manufacturer_id")
        refs = ref("brands", "manufacturer")
    elif resource in ("smartphones", "tablets", "watches", "pdas", "laptops", "monitors"):
        rows = rows.join(named(brands, "brand", "country"), "brand_id")
        refs = [*ref("brands", "brand"), F.col("brand_country")]
        if resource == "laptops":
            for p in ("cpu", "gpu"):
                # The laptop keeps the name its source gave besides that of the part it refers to.
                rows = rows.join(parents[f"{p}s"].select(F.col("id").alias(f"{p}_id"), F.col("slug").alias(f"{p}_slug"), F.col("name").alias(f"{p}_part_name")), f"{p}_id", "left")
                refs += [F.col(f"{p}_slug"), F.col(f"{p}_part_name"), url(f"{p}s", f"{p}_slug").alias(f"{p}_url")]
        elif resource != "monitors":
            chip = named(parents["socs"], "soc", "manufacturer_id").join(named(brands, "soc_manufacturer"), "soc_manufacturer_id").drop("soc_manufacturer_id")
            rows = rows.join(chip, "soc_id", "inner" if resource == "smartphones" else "left")
            refs += [*ref("socs", "soc"), *ref("brands", "soc_manufacturer")]
    return rows.select("id", "slug", "name", *own, *refs, url(resource, "slug").alias("url"))
