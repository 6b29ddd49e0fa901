"""Orphans, nested records, units and compaction: brute force and edge cases."""

import json
import math

import duckdb
from pyspark.sql import functions as F

from specloom.operators import nested, orphans, units
from specloom.sources.tables import counting_rows
from specloom.streaming import compactor

SF = "/root/testdata/sf0.001"


def test_counting_rows(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "b"), (2, None, "c"), (None, 5, "d")], "id int, updated_at int, x string")
    assert sorted(map(tuple, counting_rows(df).collect())) == [(1, 2, "b"), (2, None, "c")]


def _state(spark, refs, brands, path=None):
    state = orphans.OrphanState(spark, path)
    state.apply([
        orphans.Source("r", refs, {"brand_id": ("brands", orphans.id_key(F.col("brand_id")))}),
        orphans.Source("b", brands, {}, {"brands": orphans.id_key(F.col("id"))}, F.col("deleted_at").isNull()),
    ])
    return state


def _orphans(state):
    return sorted(r["row_id"] for r in state.orphans().collect())


def test_orphans_edges(spark):
    t = lambda s: f"timestamp_ntz'2024-01-{s} 00:00:00'"
    brands = spark.sql(f"select * from values (1L, 'one', {t('02')}, {t('02')}, cast(null as timestamp_ntz)), (2L, 'two', {t('02')}, {t('02')}, null), (2L, 'two', {t('02')}, {t('05')}, {t('05')}) as b(id, slug, created_at, updated_at, deleted_at)")
    refs = spark.sql(f"select * from values (10L, 1L, {t('03')}, {t('03')}), (11L, 1L, {t('01')}, {t('03')}), (12L, 2L, {t('03')}, {t('03')}), (13L, 0L, {t('03')}, {t('03')}), (14L, cast(null as bigint), {t('03')}, {t('03')}), (15L, -1L, {t('03')}, {t('03')}), (15L, 1L, {t('03')}, {t('04')}), (13L, 0L, {t('03')}, {t('03')}), (cast(null as bigint), 0L, {t('03')}, {t('03')}) as r(id, brand_id, created_at, updated_at)").withColumn("key", F.lit("clash"))
    whole = _state(spark, refs, brands)
    assert _orphans(whole) == [11, 12, 13]
    assert sorted(tuple(r) for r in whole.report().collect()) == [("r", "brand_id", "2024-01", 3, 3)] and sorted(tuple(r) for r in whole.missing_keys().collect()) == [("r", "brand_id", "0", 1), ("r", "brand_id", "2", 1)]
    assert _orphans(_state(spark, refs.limit(0), brands)) == []
    assert _orphans(_state(spark, refs, brands.limit(0))) == [10, 11, 12, 13, 15]


def test_orphan_counts_are_kept_up_over_turns(spark, tmp_path):
    """Late, repeated and out-of-order versions, withdrawals and late targets, each turn by a state opened anew."""
    import random

    rnd = random.Random(3)
    day = lambda n: f"timestamp_ntz'2024-01-{n:02d} 00:00:00'"
    null = "cast(null as timestamp_ntz)"
    refs = [(rnd.randint(1, 25), rnd.randint(0, 9), rnd.randint(1, 28), rnd.randint(1, 28)) for _ in range(120)]
    brands = [(rnd.randint(0, 9), rnd.randint(1, 28), rnd.randint(1, 28), rnd.random() < 0.3) for _ in range(30)]
    # One version has one content, as tables give it.
    refs, brands = list({(r[0], r[3]): r for r in refs}.values()), list({(b[0], b[2]): b for b in brands}.values())
    of_refs = lambda rows: spark.sql("select * from values " + ", ".join(f"({i}L, {b}L, {day(c)}, {day(u)})" for i, b, c, u in rows) + " as r(id, brand_id, created_at, updated_at)")
    of_brands = lambda rows: spark.sql("select * from values " + ", ".join(f"({i}L, {day(c)}, {day(u)}, {day(u) if gone else null})" for i, c, u, gone in rows) + " as b(id, created_at, updated_at, deleted_at)")
    path = f"file://{tmp_path}/state"
    for i in range(3):
        state = _state(spark, of_refs(refs[i::3] + refs[:5]), of_brands(brands[i::3]), path)
    assert orphans.OrphanState(spark, path).turns == 3
    last_ref, last_brand = {}, {}
    for r in sorted(refs, key=lambda r: r[3]):
        last_ref[r[0]] = r
    for b in sorted(brands, key=lambda b: b[2]):
        last_brand[b[0]] = b
    want = sorted(i for i, b, c, _ in last_ref.values() if not (b in last_brand and not last_brand[b][3] and last_brand[b][1] <= c))
    assert _orphans(state) == want and want
    assert state.report().agg(F.sum("orphans")).first()[0] == len(want)
    assert state.counts().where("ref_field is not null").agg(F.sum("n")).first()[0] == len(last_ref)


def test_nested_shapes(spark, tmp_path):
    cam = {"type": "main", "mp": 5, "modes": [{"res": "1080p", "fps": [30]}, None, {}, {"res": "720p"}]}
    rows = [
        (1, json.dumps([cam, None, {}, {"type": "selfie"}])),
        (2, json.dumps(json.dumps({"0": {"type": "a", "modes": json.dumps([{"res": "x"}])}, "1": None, "2": {"type": "b", "video": {"codec": None, "modes": {"res": "y"}}}}))),
        (3, json.dumps({"rear": [{"type": "r"}, {"type": "s"}], "front": {"type": "f"}})),
        (4, json.dumps({"type": "only"})),
        (5, None),
        (6, "{broken"),
        (7, ""),
        (8, "null"),
    ]
    df = spark.createDataFrame(rows, "id bigint, cameras string").withColumn("owner_id", F.lit("clash"))
    got = {(r["owner_id"], r["child"], r["pos"], r["sub_pos"]) for r in nested.flatten(df, "d", {"cameras": nested.CAMERAS}).collect()}
    assert got == {
        (1, "camera", 0, -1), (1, "camera", 3, -1), (1, "camera_mode", 0, 0), (1, "camera_mode", 0, 3),
        (2, "camera", 0, -1), (2, "camera", 2, -1), (2, "camera_mode", 0, 0), (2, "camera_mode", 2, 0),
        (3, "camera", 0, -1), (3, "camera", 1, -1), (3, "camera", 2, -1), (4, "camera", 0, -1),
    }
    shown = nested.typed_table(nested.flatten(df, "d", {"cameras": nested.CAMERAS}), "camera_mode").where("owner_id = 1 and sub_pos = 0").first()
    assert shown["res"] == "1080p" and shown["fps"] == [30] and shown["parent"] == "camera:0"
    flat = nested.flatten(df, "d", {"cameras": nested.CAMERAS})
    assert {r["subtype"] for r in flat.where("child = 'camera'").collect()} == {"flat", "modes:list", "video:map"}
    assert nested.subtype_table(flat, "camera", "flat").columns == ["owner_table", "owner_id", "pos", "sub_pos", "parent", "type", "mp", "aperture", "ois"]
    nested.write_subtypes(flat, f"{tmp_path}/subtypes")
    routed = spark.read.parquet(f"{tmp_path}/subtypes")
    assert routed.count() == flat.count() and routed.where("child = 'camera_mode' and subtype = 'fps:list'").count() == 1
    only = nested.flatten(df, "d", {"cameras": nested.CAMERAS, "display": nested.PANELS}, only="camera_mode", bodies=False)
    assert {(r["child"], r["body"]) for r in only.collect()} == {("camera_mode", None)} and only.count() == 4
    display = spark.createDataFrame([(1, '{"type":"IPS","panels":{"role":"main"}}'), (2, '[{"role":"a"},{},{"role":"b"}]'), (3, '{"type":"IPS"}'), (4, '{"panels":{"main":{"role":"m"},"slot1":null,"cover":{"role":"c"}}}')], "id bigint, display string")
    assert {(r["owner_id"], r["pos"]) for r in nested.flatten(display, "d", {"display": nested.PANELS}).collect()} == {(1, 0), (2, 0), (2, 2), (4, 0), (4, 2)}
    assert nested.flatten(display.limit(0), "d", {"display": nested.PANELS}).count() == 0


def test_units(spark):
    texts = {
        "base_clock_ghz": {"2.8 ghz": ("ghz", 2.8), "2100": ("mhz", 2.1), "base 1,8 gigahertz, boost 2145 MHz": ("ghz", 1.8), "4488 MHz boost, 3.00 Ghz base": ("ghz", 3.0), "Base: 3100 MHZ; turbo 4.0 GHz": ("mhz", 3.1), "GHZ 4,1[7]": ("ghz", 4.1), "3700000": ("khz", 3.7), "3'900 Mhz": ("mhz", 3.9), "1,500 megahertz": ("mhz", 1.5)},
        "base_clock_mhz": {"1.29": ("ghz", 1290.0), "2,075 GHZ[8]": ("ghz", 2075.0), "510,000,000Hz": ("hz", 510.0), "515 megahertz": ("mhz", 515.0)},
        "l3_cache_mb": {"2×4 megabytes": ("mb", 8.0), "12 288KB": ("kb", 12.0), "64": ("mb", 64.0), "8192": ("kb", 8.0), "67108864bytes": ("b", 64.0), "L3: 0.0234375 GB": ("gb", 24.0), "4×1536 kilobytes": ("kb", 6.0), "1,5 MiB": ("mb", 1.5), "2048 K shared": ("kb", 2.0)},
    }
    rows, want, i = [], {}, 0
    for field, table in texts.items():
        for t, (unit, value) in table.items():
            rows.append((i, field, t))
            want[i] = (unit, value)
            i += 1
    rows += [(i, "base_clock_ghz", x) for i, x in enumerate([None, "", "-", "n/a", "0 GHz"], 1000)] + [(2000, "other", "5 MHz")]
    spec = spark.createDataFrame(rows, "reading_id bigint, spec_field string, value_text string").withColumn("value", F.lit("clash"))
    cpus = spark.createDataFrame([(1, 2900.0, 4.2, 36.0), (2, None, None, 37748736.0), (3, 3.1, None, None)], "id bigint, base_clock_ghz double, boost double, l3_cache_mb double")
    out = units.standardise([("cpus", cpus)], spec).collect()
    got = {r["row_id"]: (r["stated_unit"], r["value"]) for r in out if r["src_table"] == "spec_readings"}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0] and abs(got[k][1] / want[k][1] - 1) < 1e-9, (rows[k], got[k])
    assert {(r["row_id"], r["spec_field"], r["stated_unit"]) for r in out if r["src_table"] == "cpus"} == {(1, "base_clock_ghz", "mhz"), (1, "l3_cache_mb", "mb"), (2, "l3_cache_mb", "b"), (3, "base_clock_ghz", "ghz")}


def test_units_that_nothing_settles_are_flagged(spark):
    """A bare number as near to the centre in one unit as in another, and one that its boost clock settles."""
    spec = spark.createDataFrame([(i, "base_clock_ghz", f"{x} GHz") for i, x in enumerate((2.8, 2.9, 3.0))] + [(10, "base_clock_ghz", "92"), (11, "base_clock_ghz", "2900")], "reading_id bigint, spec_field string, value_text string")
    cpus = spark.createDataFrame([(1, 92.0, None), (2, 92.0, 120.0), (3, 2.9, 4100.0), (4, 2900.0, 3.7)], "id bigint, base_clock_ghz double, boost double")
    got = {(r["src_table"], r["row_id"]): (r["stated_unit"], r["unique_solution"]) for r in units.standardise([("cpus", cpus)], spec).collect()}
    assert not got[("spec_readings", 10)][1] and not got[("cpus", 1)][1] and got[("spec_readings", 11)] == ("mhz", True)
    assert got[("cpus", 3)] == ("ghz", True) and got[("cpus", 4)] == ("mhz", True) and got[("spec_readings", 0)] == ("ghz", True)
    # The combination of base and boost is the best of all sixteen, by brute force.
    size = {"hz": 1.0, "khz": 1e3, "mhz": 1e6, "ghz": 1e9}
    mid = math.log(2.9e9)
    for base, boost in ((3.0, 4000.0), (250.0, 3.9), (41.0, 52.0), (3100.0, 4.0)):
        cost = {(u, w): abs(math.log(base * a) - mid) + abs(y) + abs(y - (math.log(base * a) - mid)) for u, a in size.items() for w, b in size.items() for y in (math.log(boost * b) - units.BOOST_RATIO_LOG - mid,)}
        one = spark.createDataFrame([(1, base, boost)], "id bigint, base_clock_ghz double, boost double")
        assert [r["stated_unit"] for r in units.standardise([("cpus", one)], spec.where("reading_id < 3")).where("src_table = 'cpus'").collect()] == [min(cost, key=cost.get)[0]]


def test_whole_records():
    a, b = {"record_uid": 1, "s": "}{"}, {"record_uid": 2, "d": {"x": [1]}}
    uid = lambda body: sorted(r["record_uid"] for r in compactor.whole_records(body))
    ja, jb = json.dumps(a), json.dumps(b, indent=1)
    assert uid(ja) == [1] and uid("﻿" + jb + "\n") == [2] and uid(f"[{ja},{jb}]") == [1, 2] and uid(f"{ja}\n{jb}") == [1, 2]
    assert uid(ja + "\n" + jb[:-5]) == [1] and uid(f"[{ja},{jb[:-5]}") == [1] and uid(ja[:-2] + "\n" + ja.replace("1", "3")) == [3]
    assert uid(None) == uid("") == uid("null") == uid("{}") == uid("[]") == uid('{"record_uid":null}') == []


def test_compaction_takes_new_files_once(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    one = spark.createDataFrame([(5, '{"record_uid":1}'), (3, '{"record_uid":1}'), (4, '{"record_uid":2}\n{"rec'), (6, None)], "file_id bigint, body string")
    one.write.parquet(src)
    assert sorted((r["record_uid"], r["file_id"]) for r in compactor.compact(spark, src, out).collect()) == [(1, 3), (2, 4)]
    spark.createDataFrame([(1, '[{"record_uid":2},{"record_uid":9}]')], "file_id bigint, body string").write.mode("append").parquet(src)
    before = compactor.Store(spark, out).manifest()
    again = compactor.compact(spark, src, out)
    assert sorted((r["record_uid"], r["file_id"]) for r in again.collect()) == [(1, 3), (2, 1), (9, 1)]
    # Buckets without a new record keep their version; the others' old ones can be emptied.
    store = compactor.Store(spark, out)
    after, where = store.manifest(), lambda u: spark.range(1).select(F.pmod(F.xxhash64(F.lit(u).cast("bigint")), F.lit(compactor.BUCKETS))).first()[0]
    assert {b for b in after if before.get(b) != after[b]} == {where(2), where(9)}
    assert store.vacuum() == len([b for b in before if before[b] != after[b]]) and store.table().count() == 3


def test_compaction_of_many_files_in_batches(spark, tmp_path):
    """Every record once with its lowest file, whatever the batches; a batch done twice changes nothing."""
    import random

    rnd = random.Random(9)
    rows, want = [], {}
    for f in range(240):
        uids = [rnd.randint(1, 150) for _ in range(rnd.randint(0, 4))]
        rows.append((f, "\n".join(json.dumps({"record_uid": u, "of": f}) for u in uids) or None))
        for u in uids:
            want[u] = min(want.get(u, f), f)
    rnd.shuffle(rows)
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    df = spark.createDataFrame(rows, "file_id bigint, body string").repartition(40)
    df.write.parquet(src)
    got = compactor.compact(spark, src, out, batch_bytes=10_000)
    assert {r["record_uid"]: r["file_id"] for r in got.collect()} == want and got.count() == len(want)
    assert all(json.loads(r["record"])["of"] == r["file_id"] for r in got.collect())
    store = compactor.Store(spark, out)
    turns = {t for t in store.manifest().values()}
    assert max(turns) > 1
    store.add(compactor.records(df), max(turns))
    assert {r["record_uid"]: r["file_id"] for r in store.table().collect()} == want
    assert store.table().select(F.input_file_name()).distinct().count() <= compactor.BUCKETS
    # An empty folder, and one file.
    df.limit(0).write.parquet(f"{tmp_path}/none")
    assert compactor.compact(spark, f"{tmp_path}/none").count() == 0
    df.coalesce(1).write.parquet(f"{tmp_path}/one")
    part = next(p for p in (tmp_path / "one").iterdir() if p.name.endswith(".parquet"))
    assert compactor.compact(spark, str(part)).count() == len(want)


def test_queries_match_their_sql(spark):
    """Every core query with SQL, at the smallest size."""
    import glob
    import math
    import os

    from specloom.plans import registry

    con = duckdb.connect()
    for p in glob.glob(SF + "/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else format(v, ".9g")
        return str(v)

    for name, sql in registry.ORACLE.items():
        df = registry.QUERIES[name](spark, SF)
        want = con.sql(sql)
        cols = sorted(df.columns)
        assert cols == sorted(want.columns), name
        a = sorted([norm(r[c]) for c in cols] for r in df.collect())
        b = sorted([norm(r[want.columns.index(c)]) for c in cols] for r in want.fetchall())
        assert a == b, name
