"""From scraped rows to drafts, from drafts to new documents, and from score tables into documents."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from specloom.functions import parsers
from specloom.functions.text import fold_ascii, slugify
from specloom.sources import html

# How makers are written, their names in front of a model, and the words in headers.
PREFIXES = {
    "intel": ("intel",),
    "amd": ("advanced micro devices", "amd"),
    "nvidia": ("nvidia corporation", "nvidia"),
    "samsung": ("samsung electronics", "samsung"),
    "apple": ("apple inc.", "apple"),
    "qualcomm": ("qualcomm technologies", "qualcomm"),
    "lg": ("lg electronics", "lg"),
    "asus": ("asustek", "asus"),
}
DISPLAY = {"cpu": {"intel": "Intel", "amd": "AMD"}, "gpu": {"nvidia": "NVIDIA", "amd": "AMD", "intel": "Intel"}, "smartphone": {"oneplus": "OnePlus"}}
HEADERS = {
    "cpu": {
        "model": ["model", "processor", "cpu", "name"],
        "architecture": ["architecture", "codename", "code name", "core name"],
        "cores": ["cores", "core"],
        "threads": ["threads", "thread"],
        "base_clock": ["base", "freq", "clock"],
        "boost_clock": ["boost", "turbo", "max"],
        "l3_cache": ["l3", "cache"],
        "tdp": ["tdp", "power", "wattage"],
        "release_date": ["released", "release", "launched", "launch", "date"],
        "socket": ["socket"],
        "process_node": ["process", "fab", "node", "lithography"],
    },
    "gpu": {
        "model": ["model", "card", "name"],
        "architecture": ["architecture", "codename", "code name", "chip"],
        "release_date": ["released", "release", "launched", "launch", "date"],
        "memory": ["memory", "vram"],
        "memory_type": ["memory type", "mem type", "type"],
        "memory_bus": ["bus", "interface"],
        "base_clock": ["base", "core clock"],
        "boost_clock": ["boost", "turbo", "max"],
        "tdp": ["tdp", "tbp", "power"],
        "process_node": ["process", "fab", "lithography"],
        "pcie": ["pcie", "pci-e", "pci express"],
    },
    "smartphone": {
        "model": ["model", "name"],
        "release_date": ["released", "release", "launched", "launch", "date"],
        "soc": ["soc", "chipset", "processor", "platform"],
        "ram": ["ram", "memory"],
        "battery": ["battery"],
        "weight": ["weight", "mass"],
        "os": ["os", "operating system", "software"],
        "display": ["display", "screen"],
        "camera": ["camera", "rear"],
    },
}
NEEDED = {
    "cpu": ("release_date", "architecture", "cores", "threads"),
    "gpu": ("architecture", "release_date", "memory_gb", "memory_type", "memory_bus_bit", "base_clock_mhz", "boost_clock_mhz", "tdp_w", "pcie_version"),
    "smartphone": ("soc", "release_date", "ram_gb", "battery_mah", "weight_g", "os"),
}


def model_slug(name: Column, maker: Column) -> Column:
    """The slug of a model without its maker in front, as each maker is written."""
    quoted = F.concat(F.lit(r"\Q"), maker, F.lit(r"\E"))
    fronts = reduce(lambda acc, x: F.when(maker == x[0], "|".join(p.replace(".", r"\.") for p in x[1])).otherwise(acc), PREFIXES.items(), quoted)
    return slugify(F.regexp_replace(F.lower(F.trim(fold_ascii(name))), F.concat(F.lit("^(?:"), fronts, F.lit(")(?: |$)")), F.lit("")))


def display_name(model: Column, maker: Column, category: str) -> Column:
    """The model, with its maker in front unless it begins with it."""
    shown = reduce(lambda acc, x: F.when(maker == x[0], x[1]).otherwise(acc), DISPLAY[category].items(), F.initcap(maker))
    return F.when(F.lower(model).startswith(maker), model).otherwise(F.concat(shown, F.lit(" "), model))


def _field(name: str) -> Column:
    return F.coalesce(F.try_element_at("cells", F.lit(name)), F.lit(""))


def _blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def coverage_points(pages: DataFrame, category: str) -> DataFrame:
    """(category, manufacturer, name, slug, source, url, row_no) that pages (manufacturer, title, html) list.

    Processors and cards need a slug that looks like a model's; phones one of three letters.
    """
    cells = html.page_first_cells(pages, ("manufacturer", "title")).withColumn("slug", model_slug(F.col("text"), F.col("manufacturer")))
    fits = F.length("slug") >= 3 if category == "smartphone" else parsers.probable_model_slug(F.col("slug"))
    address = F.concat(F.lit("https://en.wikipedia.org/wiki/"), "title")
    return cells.where(fits).select(F.lit(category).alias("category"), "manufacturer", F.col("text").alias("name"), "slug", F.concat(F.lit("wikipedia:"), "title").alias("source"), address.alias("url"), "row_no")


def missing_fields(columns: tuple[str, ...]) -> Column:
    """Names of the columns that are null or blank, in the order given."""
    return F.array_compact(F.array(*[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(c)) for c in columns]))


def drafts(pages: DataFrame, category: str, socs: DataFrame | None = None, brands: DataFrame | None = None) -> DataFrame:
    """Draft records of the rows of pages (manufacturer, title, html, and fallback for processors).

    Gives category, manufacturer, slug, name, the parsed columns, source_url, missing_fields,
    output_path and row_no. Phones of a brand that ``brands`` (slug) lacks are left out, and
    a chip counts only if ``socs`` (slug) has it.
    """
    c, maker = F.col, F.col("manufacturer")
    if "fallback" not in pages.columns:
        pages = pages.withColumn("fallback", F.lit(None).cast("string"))
    if brands is not None:
        pages = pages.join(brands.select(c("slug").alias("manufacturer")).distinct(), "manufacturer", "left_semi")
    rows = html.page_fields(pages, HEADERS[category], ("manufacturer", "title", "fallback"))
    rows = rows.withColumn("model", _field("model")).withColumn("slug", model_slug(c("model"), maker))
    fits = F.length("slug") >= 3 if category == "smartphone" else (F.length("slug") >= 4) & c("slug").rlike("[0-9]")
    rows = rows.where(fits).withColumns({"name": display_name(c("model"), maker, category), "release_date": parsers.date(_field("release_date")), "source_url": F.concat(F.lit("https://en.wikipedia.org/wiki/"), "title")})
    year = F.coalesce(F.year("release_date").cast("string"), F.lit("unknown"))
    if category == "cpu":
        pair = parsers.cores_threads(_field("cores"))
        rows = rows.withColumns({
            "segment": parsers.cpu_segment(c("model")), "architecture": F.coalesce(_blank(_field("architecture")), _blank(c("heading")), c("fallback")), "socket": _blank(_field("socket")), "process_node": _blank(_field("process_node")),
            "cores": pair["cores"], "threads": F.coalesce(F.nullif(parsers.first_int(_field("threads")), F.lit(0)), pair["threads"]), "base_clock_ghz": parsers.frequency_ghz(_field("base_clock")), "boost_clock_ghz": parsers.frequency_ghz(_field("boost_clock")),
            "l3_cache_mb": parsers.cache_mb(_field("l3_cache")), "tdp_w": parsers.tdp_w(_field("tdp")),
        })
        own = ["segment", "architecture", "socket", "process_node", "cores", "threads", "base_clock_ghz", "boost_clock_ghz", "l3_cache_mb", "tdp_w"]
        folder = F.concat_ws("/", F.lit("cpu"), maker, year, F.when(c("segment").isin("server", "hedt"), "enterprise").otherwise("consumer"))
    elif category == "gpu":
        rows = rows.withColumns({
            "segment": parsers.gpu_segment(c("model")), "architecture": F.coalesce(_blank(_field("architecture")), _blank(c("heading")), c("fallback")), "memory_gb": parsers.memory_gb(_field("memory")), "memory_type": _blank(F.upper(_field("memory_type"))), "memory_bus_bit": parsers.memory_bus_bit(_field("memory_bus")),
            "base_clock_mhz": parsers.frequency_mhz(_field("base_clock")), "boost_clock_mhz": parsers.frequency_mhz(_field("boost_clock")), "tdp_w": parsers.tdp_w(_field("tdp")), "pcie_version": parsers.pcie_version(_field("pcie")),
        })
        own = ["segment", "architecture", "memory_gb", "memory_type", "memory_bus_bit", "base_clock_mhz", "boost_clock_mhz", "tdp_w", "pcie_version"]
        folder = F.concat_ws("/", F.lit("gpu"), maker, year, c("segment"))
    else:
        rows = rows.withColumns({"_soc": parsers.soc_slug(_field("soc")), "ram_gb": parsers.ram_gb(_field("ram")), "battery_mah": parsers.battery_mah(_field("battery")), "weight_g": parsers.weight_g(_field("weight")), "os": parsers.os_name(_field("os"), maker)})
        known = rows.sparkSession.createDataFrame([], "slug string") if socs is None else socs
        rows = rows.join(known.select(c("slug").alias("_soc"), c("slug").alias("soc")).distinct(), "_soc", "left")
        own = ["soc", "ram_gb", "battery_mah", "weight_g", "os"]
        folder = F.concat_ws("/", F.lit("smartphone"), maker)
    return rows.select(
        F.lit(category).alias("category"), "manufacturer", "slug", "name", "release_date", *own, "source_url", missing_fields(NEEDED[category]).alias("missing_fields"), F.concat(folder, F.lit("/"), "slug", F.lit(".json")).alias("output_path"), "title", "row_no",
    )


def sorted_out(candidates: DataFrame, curated: DataFrame, order: list[str], include_drafts: bool = False) -> DataFrame:
    """Candidates with what becomes of them: ``existing``, ``written``, ``duplicate`` or ``incomplete``.

    The curated set (category, manufacturer, slug) stays as it is. Of the complete ones (all
    with ``include_drafts``) of one slug the first in order is written, what follows it is a
    duplicate; an incomplete one before it stands in no one's way.
    """
    keys = ["category", "manufacturer", "slug"]
    fits = F.lit(True) if include_drafts else F.size("missing_fields") == 0
    held = candidates.join(curated.select(*keys).distinct().withColumn("_held", F.lit(True)), keys, "left")
    # One row a slug, so a slug that a third of the candidates bear stays spread.
    new = candidates.where(fits).join(curated.select(*keys).distinct(), keys, "left_anti")
    firsts = new.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(F.struct(*order)).alias("_first"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    at = F.struct(*order)
    outcome = F.when(F.col("_held"), "existing").when(F.col("_first").isNotNull() & (at == F.col("_first")), "written").when(F.col("_first").isNotNull() & (at > F.col("_first")), "duplicate").otherwise("incomplete")
    return held.join(firsts, same, "left").withColumn("outcome", outcome).drop("_held", "_first", *[f"_{k}" for k in keys])


def score_table(pages: DataFrame, reader: Callable, key: Callable[[Column], Column], keep: str = "first") -> DataFrame:
    """(key, scores, url): the fields a reader finds per part; of several of a field the first, last or greatest.

    A page is in one task and its rows keep their order; pages follow each other by address.
    """
    found = html.page_scores(pages, reader).withColumn("key", key(F.col("name"))).where("key <> ''")
    at = F.struct("url", "line_no")
    one = {"first": F.min_by("value", at), "last": F.max_by("value", at), "max": F.max("value")}[keep]
    fields = found.groupBy("key", "field").agg(one.alias("value"), F.min("url").alias("url"))
    return fields.groupBy("key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "value")))).alias("scores"), F.min("url").alias("url"))


def with_prefix(scores: Column, prefix: str) -> Column:
    """The entries of a map whose key begins like this."""
    return F.map_filter(scores, lambda k, _: k.startswith(prefix))


def page_results(pages: DataFrame) -> DataFrame:
    """(asked, key, mark, single, url) of pages (asked, url, html) of one part each, whose heading is the part asked for."""

    def run(batches):
        for pdf in batches:
            read = [html.part_page(p) for p in pdf["html"]]
            yield pdf[["asked", "url"]].assign(heading=[h for h, _ in read], body=[t for _, t in read])

    read = pages.select("asked", "url", "html").mapInPandas(run, "asked string, url string, heading string, body string")
    marks = read.withColumn("m", parsers.page_marks(F.col("body"))).where(parsers.same_part(F.col("heading"), F.col("asked")) & F.col("m").isNotNull())
    return marks.select("asked", parsers.cpu_key(F.col("heading")).alias("key"), "m.mark", "m.single", "url")


def looked_up_ids(lists: DataFrame) -> DataFrame:
    """(asked, id): the first entry of each result list (asked, html) that is exactly the part asked for."""

    def run(batches):
        for pdf in batches:
            out = [(asked, n, name, i) for asked, page in zip(pdf["asked"], pdf["html"]) for n, (name, i) in enumerate(html.looked_up(page))]
            yield pd.DataFrame(out, columns=["asked", "n", "name", "id"])

    rows = lists.select("asked", "html").mapInPandas(run, "asked string, n int, name string, id string")
    return rows.where(parsers.same_part(F.col("name"), F.col("asked"))).groupBy("asked").agg(F.min_by("id", "n").alias("id"))


def first_of(names: DataFrame, override: DataFrame, direct: DataFrame, resolved: DataFrame) -> DataFrame:
    """(asked, mark, single, url, how): the override's page if there is an override, else the searched page, else the looked-up one.

    ``override`` lists every name with an override, with null marks where its page gave none.
    """
    part = lambda df, n: df.select("asked", F.struct("mark", "single", "url").alias(n))
    joined = names.select("asked").join(part(override, "_o"), "asked", "left").join(part(direct, "_d"), "asked", "left").join(part(resolved, "_r"), "asked", "left")
    how = F.when(F.col("_o").isNotNull(), "override").when(F.col("_d").isNotNull(), "direct").when(F.col("_r").isNotNull(), "resolved")
    return joined.select("asked", F.coalesce("_o", "_d", "_r").alias("r"), how.alias("how")).where("r.mark is not null").select("asked", "r.mark", "r.single", "r.url", "how")


def enriched(records: DataFrame, scores: DataFrame, key: Callable[[Column], Column], primary: str | None, fields: list[str], order: str = "path", years: tuple[int | None, int | None] = (None, None), limit: int | None = None) -> DataFrame:
    """Records with nulls among ``fields`` filled from a score table (key, scores, url) of their name.

    Gives the records with ``outcome``: already (the primary field is there, or nothing was
    null), skipped (outside the years, compared as texts, or beyond ``limit`` records in
    order), filled, or unresolved. Values never overwrite; a filled record's source_urls get
    the address, once.
    """
    c = F.col
    year = F.left(F.coalesce(F.nullif(c("release_date").cast("string"), F.lit("")), F.lit("0")), F.lit(4))
    lo, hi = years
    inside = (F.lit(True) if lo is None else year >= str(lo)) & (F.lit(True) if hi is None else year <= str(hi))
    open_ = F.lit(True) if primary is None else c(primary).isNull()
    rows = records.withColumn("_asked", open_ & inside).withColumn("_open", open_)
    if limit is not None:
        asked = rows.where("_asked").select(order).orderBy(order).limit(limit).withColumn("_within", F.lit(True))
        rows = rows.join(asked, order, "left").withColumn("_asked", c("_asked") & F.coalesce("_within", F.lit(False))).drop("_within")
    found = scores.select(c("key").alias("_key"), "scores", c("url").alias("_url"))
    rows = rows.withColumn("_key", key(c("name"))).join(found, "_key", "left")
    new = {f: F.when(c("_asked") & c(f).isNull(), F.try_element_at("scores", F.lit(f)).cast(records.schema[f].dataType)) for f in fields}
    changes = reduce(lambda a, b: a | b, [v.isNotNull() for v in new.values()])
    outcome = F.when(~c("_open"), "already").when(~c("_asked"), "skipped").when(c("scores").isNull(), "unresolved").when(changes, "filled").otherwise("already")
    urls = F.coalesce("source_urls", F.array().cast("array<string>"))
    out = rows.withColumn("outcome", outcome)
    added = F.when((c("outcome") == "filled") & ~F.array_contains(urls, c("_url")), F.array_append(urls, c("_url"))).otherwise(c("source_urls"))
    return out.withColumns({**{f: F.coalesce(c(f), v) for f, v in new.items()}, "source_urls": added}).select(*records.columns, "outcome")


def outcome_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@pandas_udf(StringType())
def filled_document(raw: pd.Series, scores: pd.Series, url: pd.Series) -> pd.Series:
    """A document's text with absent and null fields filled and the address added; null where nothing changes or raw is no object."""

    def one(text, values, address):
        try:
            doc = json.loads(text)
        except (TypeError, ValueError):
            return None
        new = {k: v for k, v in (json.loads(values) if values else {}).items() if isinstance(doc, dict) and doc.get(k) is None}
        if not new:
            return None
        doc.update({k: int(v) if float(v).is_integer() else v for k, v in new.items()})
        urls = doc.setdefault("source_urls", [])
        if address not in urls:
            urls.append(address)
        return json.dumps(doc, indent=2, ensure_ascii=False) + "\n"

    return pd.Series([one(*x) for x in zip(raw, scores, url)], dtype=object)


def coverage_gaps(points: DataFrame, curated: DataFrame, most: int = 30) -> tuple[DataFrame, DataFrame]:
    """Per category and maker the counts of slugs upstream, curated and missing; and the first missing slugs of each.

    The second has category, manufacturer, slug, name, url and ``more``, the number beyond
    the ``most`` that are listed. A slug's name and address are those of its first point by
    source and row.
    """
    by = ["category", "manufacturer"]
    slugs = points.groupBy(*by, "slug").agg(F.min_by(F.struct("name", "url"), F.struct("source", "row_no")).alias("m"))
    held = curated.select(*by, "slug").distinct()
    gaps = slugs.join(held, [*by, "slug"], "left_anti")
    count = lambda df, name: df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
    zero = lambda n: F.coalesce(n, F.lit(0)).cast("bigint").alias(n)
    totals = count(slugs, "upstream").join(count(held, "curated"), by, "left").join(count(gaps, "missing"), by, "left").select(*by, "upstream", zero("curated"), zero("missing"))
    ranked = gaps.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("slug"))).where(F.col("_r") <= most)
    more = F.greatest(F.col("missing") - most, F.lit(0)).alias("more")
    return totals, ranked.join(totals, by).select(*by, "slug", "m.name", "m.url", more)


def coverage_markdown(totals: DataFrame, listed: DataFrame) -> str:
    """The report as text; a row per maker and listed slug comes to the driver."""
    names: dict[tuple, list] = {}
    for r in listed.orderBy("category", "manufacturer", "slug").toLocalIterator():
        names.setdefault((r["category"], r["manufacturer"]), []).append(r)
    sections, total = [], 0
    for t in totals.orderBy("category", "manufacturer").toLocalIterator():
        total += t["missing"]
        lines = [f"## {t['category']} / {t['manufacturer']}: {t['missing']} missing (upstream {t['upstream']}, curated {t['curated']})"]
        some = names.get((t["category"], t["manufacturer"]), [])
        lines += [f"- `{r['slug']}` {r['name']}" + (f" ([source]({r['url']}))" if r["url"] else "") for r in some] or ["_(none)_"]
        lines += [f"_and {some[0]['more']} more_"] if some and some[0]["more"] else []
        sections.append("\n".join(lines))
    return "\n\n".join([f"# Coverage gaps\n\n**Total missing:** {total}", *sections]) + "\n"


def claim_year(entity: Column) -> Column:
    """The first year among an entity's inception claims (P571), else its publication claims (P577); JSON text."""
    claims = F.from_json(entity, "claims struct<P571:array<struct<mainsnak:struct<datavalue:struct<value:struct<time:string>>>>>,P577:array<struct<mainsnak:struct<datavalue:struct<value:struct<time:string>>>>>>")

    def year(name: str) -> Column:
        times = F.transform(claims["claims"][name], lambda x: F.left(F.ltrim(x["mainsnak"]["datavalue"]["value"]["time"], F.lit("+")), F.lit(4)))
        return F.get(F.filter(times, lambda t: t.rlike(r"^\d{4}$")), F.lit(0)).cast("int")

    return F.coalesce(year("P571"), year("P577"))


def search_hits(answers: DataFrame, entities: DataFrame) -> DataFrame:
    """(asked, rank, title, url, year) of entity searches (asked, body) and their entities (id, body); JSON texts."""
    hits = F.from_json("body", "search array<struct<id:string,label:string,match:struct<text:string>>>")["search"]
    h = answers.select("asked", F.posexplode(hits).alias("rank", "h")).select("asked", "rank", F.col("h.id").alias("id"), F.coalesce(F.nullif("h.label", F.lit("")), "h.match.text", F.lit("")).alias("title"))
    return h.join(entities.select("id", claim_year(F.col("body")).alias("year")), "id", "left").select("asked", "rank", "title", F.concat(F.lit("https://www.wikidata.org/wiki/"), "id").alias("url"), "year")


def opensearch_hits(answers: DataFrame) -> DataFrame:
    """(asked, rank, title, url) of answers (asked, body): four arrays side by side, titles second, addresses last."""
    v = F.try_parse_json("body")
    titles, urls = F.try_variant_get(v, "$[1]", "array<string>"), F.coalesce(F.try_variant_get(v, "$[3]", "array<string>"), F.array().cast("array<string>"))
    return answers.select("asked", F.posexplode(titles).alias("rank", "title"), urls.alias("_u")).select("asked", "rank", "title", F.coalesce(F.get("_u", F.col("rank")), F.lit("")).alias("url"))


def line_tiers(names: DataFrame) -> DataFrame:
    """(name, line, expected) of mainstream desktop parts whose model's second digit belongs to another line."""
    # The line that a second digit stands for.
    p = r"^AMD Ryzen (\d) (\d)(\d)\d\d(?:X3D|X|XT)?$"
    line, digit = F.regexp_extract("name", p, 1), F.regexp_extract("name", p, 3)
    expected = F.when(digit == "6", "5").when(digit.isin("7", "8"), "7").when(digit == "9", "9")
    return names.where(F.col("name").rlike(p)).select("name", line.alias("line"), expected.alias("expected")).where("expected is not null and expected <> line")


def era_breaks(parts: DataFrame) -> DataFrame:
    """(name, field) of parts whose score is beyond their time; a missing date is the earliest."""
    year = F.left(F.coalesce(F.col("release_date").cast("string"), F.lit("0")), F.lit(4))
    rules = {"passmark_cpu_mark": ("2006", 1500), "cinebench_r23_multi": ("2011", 3000)}
    found = F.array_compact(F.array(*[F.when((year < before) & (F.col(f) > most), F.lit(f)) for f, (before, most) in rules.items()]))
    return parts.select("name", F.explode(found).alias("field"))
