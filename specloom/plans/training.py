"""Queries of the general data-preparation problems (3 to 6) over the catalog's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.operators import nested, orphans, units
from specloom.sources.tables import counting_rows, table
from specloom.streaming.compactor import compact


def _orphan_state(spark: SparkSession, d: str, path: str | None = None) -> orphans.OrphanState:
    c = F.col
    state = orphans.OrphanState(spark, path)
    state.apply(
        [
            orphans.Source("smartphones", table(spark, d, "smartphones"), {"soc_id": ("socs", orphans.id_key(c("soc_id"))), "brand_id": ("brands", orphans.id_key(c("brand_id")))}),
            orphans.Source("cpus", table(spark, d, "cpus"), {"manufacturer": ("brand_slugs", orphans.slug_key(c("manufacturer.slug")))}),
            orphans.Source("socs", table(spark, d, "socs"), {}, {"socs": orphans.id_key(c("id"))}, c("deleted_at").isNull()),
            orphans.Source("brands", table(spark, d, "brands"), {}, {"brands": orphans.id_key(c("id")), "brand_slugs": orphans.slug_key(c("slug"))}, c("deleted_at").isNull()),
        ]
    )
    return state


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphan_state(spark, d).orphans().select("ref_table", "ref_field", "row_id")


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return _orphan_state(spark, d).report()


def p3_missing_keys(spark: SparkSession, d: str) -> DataFrame:
    return _orphan_state(spark, d).missing_keys()


def _flat(spark: SparkSession, d: str, only: str | None = None, bodies: bool = True) -> DataFrame:
    wanted = lambda rules: {n: r for n, r in rules.items() if only in (None, r.child, r.sub)}
    out = None
    for name, rules in (("mobile_devices", wanted({"cameras": nested.CAMERAS, "display": nested.PANELS, "connectivity": nested.BANDS})), ("socs", wanted({"cpu_config": nested.CLUSTERS}))):
        if rules:
            one = nested.flatten(counting_rows(table(spark, d, name), "id", "updated_at", *rules), name, rules, only=only, bodies=bodies)
            out = one if out is None else out.unionByName(one)
    return out


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, bodies=False).select("owner_table", "owner_id", "child", "pos", "sub_pos")


def p4_variants(spark: SparkSession, d: str) -> DataFrame:
    return nested.variants(_flat(spark, d, bodies=False))


def _typed(child: str):
    return lambda spark, d: nested.typed_table(_flat(spark, d, child), child)


def p4_camera_with_video(spark: SparkSession, d: str) -> DataFrame:
    """One subtype of cameras: those that hold a sensor and a video record."""
    return nested.subtype_table(_flat(spark, d, "camera"), "camera", "sensor:record+video:record")


def _values(spark: SparkSession, d: str) -> DataFrame:
    cpus = counting_rows(table(spark, d, "cpus"), "id", "updated_at", "base_clock_ghz", "boost_clock_ghz", "l3_cache_mb").withColumnRenamed("boost_clock_ghz", "boost")
    gpus = counting_rows(table(spark, d, "gpus"), "id", "updated_at", "base_clock_mhz", "boost_clock_mhz").withColumnRenamed("boost_clock_mhz", "boost")
    return units.standardise([("cpus", cpus), ("gpus", gpus)], table(spark, d, "spec_readings"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _values(spark, d).where("stated_unit <> field_unit").select("src_table", "row_id", "spec_field")


def p5_values(spark: SparkSession, d: str) -> DataFrame:
    return _values(spark, d)


def _compacted(spark: SparkSession, d: str) -> DataFrame:
    return compact(spark, f"{d}/draft_files.parquet")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _compacted(spark, d).select("record_uid", "file_id")


def p6_records(spark: SparkSession, d: str) -> DataFrame:
    return _compacted(spark, d)


QUERIES = {
    "p3_found": p3_found,
    "p3_report": p3_report,
    "p3_missing_keys": p3_missing_keys,
    "p4_found": p4_found,
    "p4_variants": p4_variants,
    **{f"p4_{child}": _typed(child) for child in nested.TYPED},
    "p4_camera_with_video": p4_camera_with_video,
    "p5_found": p5_found,
    "p5_values": p5_values,
    "p6_found": p6_found,
    "p6_records": p6_records,
}

_P3 = """
WITH ref AS (
  SELECT 'smartphones' AS ref_table, 'soc_id' AS ref_field, 'socs' AS target, id, CAST(soc_id AS VARCHAR) AS key, created_at
  FROM (SELECT * FROM smartphones QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1)
  UNION ALL
  SELECT 'smartphones', 'brand_id', 'brands', id, CAST(brand_id AS VARCHAR), created_at
  FROM (SELECT * FROM smartphones QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1)
  UNION ALL
  SELECT 'cpus', 'manufacturer', 'slugs', id, nullif(lower(regexp_replace(manufacturer.slug, '^\\s+|\\s+$', '', 'g')), ''), created_at
  FROM (SELECT * FROM cpus QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1)
), b AS (SELECT * FROM brands QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1),
s AS (SELECT * FROM socs QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1),
tgt AS (
  SELECT 'socs' AS target, CAST(id AS VARCHAR) AS key, created_at FROM s WHERE deleted_at IS NULL
  UNION ALL SELECT 'brands', CAST(id AS VARCHAR), created_at FROM b WHERE deleted_at IS NULL
  UNION ALL SELECT 'slugs', lower(regexp_replace(slug, '^\\s+|\\s+$', '', 'g')), created_at FROM b WHERE deleted_at IS NULL
), orphan AS (
  SELECT ref_table, ref_field, id AS row_id, key, created_at FROM ref
  WHERE key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.target = ref.target AND tgt.key = ref.key AND tgt.created_at <= ref.created_at)
)
"""

ORACLE = {
    "p3_found": _P3 + "SELECT ref_table, ref_field, row_id FROM orphan",
    "p3_report": _P3 + "SELECT ref_table, ref_field, strftime(created_at, '%Y-%m') AS month, count(*) AS orphans, count(DISTINCT key) AS missing_keys FROM orphan GROUP BY 1, 2, 3",
    "p3_missing_keys": _P3 + "SELECT ref_table, ref_field, key, count(*) AS n FROM ref WHERE key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.target = ref.target AND tgt.key = ref.key) GROUP BY 1, 2, 3",
}
