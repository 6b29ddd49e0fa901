"""The audit log of verification, the caches beside it, and the reports drawn from them."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from specloom.functions.parsers import host_of
from specloom.operators.records import last_by_key
from specloom.operators.verify import host_tier, promotion

# Answers that say nothing about a page.
TRANSIENT = (429, 503)


@pandas_udf(StringType())
def content_hash(raw: pd.Series) -> pd.Series:
    """First 16 hex digits of the SHA-256 of a JSON text with sorted keys; null where it is no JSON."""

    def one(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            value = json.loads(text)
        except ValueError:
            return None
        return hashlib.sha256(json.dumps(value, sort_keys=True, ensure_ascii=False).encode("utf-8", "surrogatepass")).hexdigest()[:16]

    return raw.map(one)


def model_key(category: Column, brand: Column, base: Column, slug: Column, path: Column) -> Column:
    """The product of a record: its brand and base model, else its slug, else its path."""
    own = F.concat_ws("/", category, F.coalesce(F.nullif(slug, F.lit("")), path))
    return F.when(F.coalesce(base, F.lit("")) != "", F.concat_ws("/", category, F.coalesce(brand, F.lit("")), base)).otherwise(own)


def entry(ts: str) -> Column:
    """A ledger entry of a scored record (category, slug, path, hash, score, band, flags, best_tier)."""
    tier0 = F.struct(F.col("score"), F.col("band"), F.col("flags"), F.col("best_tier").alias("best_host_tier"))
    return F.struct(F.lit(ts).alias("ts"), "category", "slug", "path", "hash", tier0.alias("tier0"))


def write_lines(entries: DataFrame, path: str, replace: bool = False) -> None:
    """Entries as JSON lines with sorted keys, added to a log or in place of it."""
    ordered = entries.select(*sorted(entries.columns))
    ordered.select(F.to_json(F.struct(*ordered.columns)).alias("value")).write.mode("overwrite" if replace else "append").text(path)


def latest(entries: DataFrame, order: str = "line_no") -> DataFrame:
    """The last entry of each category and slug; entries without either do not count."""
    return last_by_key(entries.where("category is not null and slug is not null"), ["category", "slug"], order)


def is_current(held: Column, now: Column) -> Column:
    """Whether an entry still describes a record: the hashes agree."""
    return F.coalesce(held == now, F.lit(False))


def instant(text: Column) -> Column:
    """A time written like 2026-01-31T12:00:00Z; other forms are null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"), F.try_to_timestamp(F.translate(text, "TZ", " "), F.lit("yyyy-MM-dd HH:mm:ss")))


def load_cache(cache: DataFrame) -> DataFrame:
    """A URL cache without answers that are no verdict; of several entries of a URL the last."""
    kept = cache.where(F.col("url").isNotNull() & ~F.coalesce(F.col("status").isin(*TRANSIENT), F.lit(False)))
    return last_by_key(kept, ["url"], "line_no") if "line_no" in cache.columns else kept


def distinct_urls(records: DataFrame, order: str) -> DataFrame:
    """(url) of all source_urls, one per host and path without slashes at its end: the first in order."""
    u = records.select(order, F.posexplode("source_urls").alias("pos", "url")).where("url is not null")
    host, path = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.regexp_replace(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/+$", "")
    return u.groupBy(host.alias("host"), path.alias("path")).agg(F.min_by("url", F.struct(order, "pos")).alias("url")).select("url")


def to_check(targets: DataFrame, cache: DataFrame, now: str, days: int) -> DataFrame:
    """Targets that the cache has no answer for of fewer than ``days`` whole days ago."""
    seconds = F.unix_timestamp(instant(F.lit(now))) - F.unix_timestamp(instant(F.col("checked_at")))
    fresh = load_cache(cache).where(F.floor(seconds / 86400) < days).select("url")
    return targets.join(fresh, "url", "left_anti")


def liveness(records: DataFrame, cache: DataFrame, *key: str) -> DataFrame:
    """(*key, live, dead, live_authoritative): a record's cached URLs, and whether one of tier 1 or 2 is alive."""
    u = records.select(*key, F.explode_outer("source_urls").alias("url")).join(load_cache(cache).select("url", "alive"), "url", "left")
    strong = F.col("alive") & host_tier(host_of(F.col("url"))).isin(1, 2)
    return u.groupBy(*key).agg(F.count_if("alive").alias("live"), F.count_if(~F.col("alive")).alias("dead"), F.coalesce(F.bool_or(strong), F.lit(False)).alias("live_authoritative"))


def liveness_summary(targets: DataFrame, cache: DataFrame) -> DataFrame:
    """(alive, dead) over target URLs."""
    return targets.join(load_cache(cache), "url").agg(F.count_if("alive").alias("alive"), F.count_if(~F.col("alive")).alias("dead"))


def dead_reasons(targets: DataFrame, cache: DataFrame, most: int = 10) -> DataFrame:
    dead = targets.join(load_cache(cache), "url").where("not alive")
    return dead.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason").limit(most)


def frontier(records: DataFrame, order: str, most: int | None = None) -> DataFrame:
    """Unverified records with a slug, the most plausible first, at most so many."""
    ranked = records.where("not verified and slug <> ''").orderBy(F.desc("score"), order)
    return ranked if most is None else ranked.limit(most)


def selected(records: DataFrame, categories: list[str], order: str, unverified: bool = False, changed: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """Records of some categories in their order, of those only unverified or changed ones, at most so many (0: none)."""
    place = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col("category"))
    out = records.where(F.col("category").isin(*categories))
    if unverified:
        out = out.where("not verified")
    if changed is not None:
        out = out.join(changed.select("path").distinct(), "path", "left_semi")
    out = out.orderBy(place, order)
    return out if most is None else out.limit(most)


def decided(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """Records with the cached decision of their category and slug and what it means for them."""
    joined = records.join(decisions.select("category", "slug", "decision"), ["category", "slug"], "left")
    return joined.withColumn("p", promotion(F.col("band"), F.col("decision"))).select(*records.columns, "decision", "p.promote", "p.reason")


def reason_counts(decided_rows: DataFrame) -> DataFrame:
    """(promote, reason, n) of unverified records with a slug."""
    return decided_rows.where("not verified and slug <> ''").groupBy("promote", "reason").agg(F.count(F.lit(1)).alias("n"))


def band_bar(green: int, yellow: int, red: int, width: int = 12) -> str:
    """A bar of so many squares in proportion to three counts; a count above 0 has one square at least."""
    squares, counts = ("🟩", "🟨", "🟥"), (green, yellow, red)
    total = sum(counts)
    if total == 0:
        return "—"
    cells = [round(width * n / total) for n in counts]
    while sum(cells) > width:
        cells[cells.index(max(cells))] -= 1
    while sum(cells) < width:
        cells[counts.index(max(counts))] += 1
    for i, n in enumerate(counts):
        if n > 0 and cells[i] == 0:
            cells[i] = 1
            cells[cells.index(max(cells))] -= 1
    return "".join(s * n for s, n in zip(squares, cells))


def status_document(rollup: DataFrame, now: str, before: dict | None = None) -> dict:
    """The status as one document, a row a category of the rollup; without a change it keeps the time it had."""
    rows = sorted((r.asDict() for r in rollup.collect()), key=lambda r: (r["category"] == "ALL", r["category"]))
    body = {"categories": {r.pop("category"): r for r in rows}}
    if before is not None and {k: v for k, v in before.items() if k != "generated_at"} == body:
        return before
    return {"generated_at": now, **body}


def markdown_table(rows: DataFrame, title: str) -> str:
    """A small result as a Markdown section; nothing but the header for no rows."""
    lines = [f"# {title}", "", "| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|")
    return "\n".join([*lines, *("| " + " | ".join(cell(v) for v in r) + " |" for r in rows.toLocalIterator())]) + "\n"


def pages_checked(urls: DataFrame, fetch, workers_by: str = "host") -> DataFrame:
    """(url, status, final_url) by a fetcher, one host in one task so that its pace can be kept.

    ``fetch`` takes a host's URLs in order and yields (status, final_url) for each, with
    whatever waiting and retrying it wants; nulls stand for no answer.
    """
    hosts = urls.withColumn(workers_by, host_of(F.col("url")))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("url")
        answers: Iterator = fetch(list(pdf["url"]))
        status, final = zip(*answers) if len(pdf) else ((), ())
        return pd.DataFrame({"url": list(pdf["url"]), "status": pd.array(list(status), dtype="Int64"), "final_url": list(final)})

    return hosts.groupBy(workers_by).applyInPandas(run, "url string, status bigint, final_url string")
