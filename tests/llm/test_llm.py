"""Record and text operators against brute force, round trips and held-out accuracy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from specloom.llm import content, entity_match, incremental_dedup, mixing, product_names, tokenizer

SF = "/root/testdata/sf0.01"


def test_names(spark):
    table = {
        "Korvano™ Mavwynqui® 29354 Pro Max": ("korvano", "mavwynqui", "29354", "promax"),
        "Veltute, Huldalmav S-19275 2nd Gen (system on a chip)": ("veltute", "huldalmav", "s19275", "gen2"),
        "Z388-KS Lozim": (None, None, "z388", "kslozim"),
        "Lozim Z 388-KS by Braxosol": ("braxosol", "lozim", "z388", "ks"),
        "Hulsel R18305 HX (Korvano)": ("korvano", "hulsel", "r18305", "hx"),
        "Edgeline 6115G (Korvano)": ("korvano", "edgeline", "611", "5g"),
        "Llonor Z12989+ (Oruvano)": ("oruvano", "llonor", "z12989", "plus"),
        "Verfiver 22651 GT/PCIe/4": (None, "verfiver", "22651", "gt"),
        "Jörvevek Edgeline V970 Lite 2GB dual SIM[3]": ("jorvevek", "edgeline", "v970", "lite"),
        "Stratum 29160U, 3.00 GHz": (None, "stratum", "29160", "u"),
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(table)] + [(90, None), (91, ""), (92, "Korvano (company)"), (93, "x" * 100_000)], "i int, name string")
    got = {r["i"]: r["p"] for r in product_names.with_product(df, F.col("name")).collect()}
    for i, (t, want) in enumerate(table.items()):
        p = got[i]
        assert (p["maker"], p["family"], p["code"], p["suffix"]) == want, (t, p)
    assert got[90] is got[91] is got[92] is None and (got[93]["family"], got[93]["code"]) == ("x" * 100_000, "")


def test_names_without_a_long_number(spark):
    """One or two digits, six and more, digits between family and number, and none at all."""
    table = {
        "iPhone 15 Pro": (None, "iphone", "15", "pro"),
        "Korvano Galaxy S9": ("korvano", "galaxy", "s9", ""),
        "Acme Chip 123456": ("acme", "chip", "123456", ""),
        "Korvano Ryzen 7 5800X": ("korvano", "ryzen", "7-5800", "x"),
        "Nothing Phone": (None, "nothing", "", ""),
        "Korvano Blue Moon": ("korvano", "bluemoon", "", ""),
    }
    df = spark.createDataFrame([*enumerate(table), (98, "List of Korvano phones"), (99, " - ")], "i int, name string")
    got = {r["name"]: r["p"] for r in product_names.with_product(df, F.col("name")).collect()}
    assert {n: tuple(got[n][f] for f in ("maker", "family", "code", "suffix")) for n in table} == table
    assert got["List of Korvano phones"] is got[" - "] is None


def test_matching_recall_and_calibration(spark):
    """Made-up products in noisy spellings: recall, precision, and confidences that hold on entries left out of the calibration."""
    rnd = random.Random(17)
    word = lambda n: "".join(rnd.choice(("ka", "lo", "mi", "ru", "ten", "vos", "zar", "pel")) for _ in range(n))
    makers = [word(3) for _ in range(8)]
    products = sorted({(rnd.choice(makers), word(3) if rnd.random() < 0.7 else "stratum", rnd.choice(("", "z")) + str(rnd.choice((7, 15, rnd.randint(100, 99999)))), rnd.choice(("", "Pro", "K"))) for _ in range(400)})

    def slip(w):
        i = rnd.randrange(1, len(w) - 1)
        return rnd.choice((w[:i] + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + w[i] + w[i:]))

    points = [(i, m, f"{m.title()} {f.title()} {c} {s}", None, "w") for i, (m, f, c, s) in enumerate(products)]
    entries, truth = [], set()
    for j in range(900):
        i = rnd.randrange(len(products))
        m, f, c, s = products[i]
        stated, known = rnd.random() < 0.7, rnd.random() < 0.5
        name = f"{slip(f) if rnd.random() < 0.2 else f} {c}{s}".replace(" ", rnd.choice((" ", "_", "  ")))
        title = f"{(slip(m) if rnd.random() < 0.1 else m).title()} {name}" if stated else name
        entries.append((j, title, f"https://e.example/{m}/{j}" if known or not stated else "u"))
        truth.add((i, j))
    p = spark.createDataFrame(points, "point_id bigint, manufacturer string, name string, slug string, source string")
    e = spark.createDataFrame(entries, "candidate_id bigint, title string, url string")
    found = {(r[0], r[1]): r[2] for r in entity_match.match_points(p, e).collect()}
    hit = len(found.keys() & truth)
    assert hit / len(truth) >= 0.97 and hit / len(found) >= 0.97 and len(set(found.values())) > 10
    # Calibrated on one half of the entries, held against the other.
    c = entity_match.classes
    left = c(entity_match.point_attributes(p)).withColumn("known", F.lit(False))
    right = lambda half: c(entity_match.candidate_attributes(e.where(f"candidate_id % 2 = {half}"))).withColumn("known", F.lit(False))
    curve = entity_match.calibration(entity_match.scored(entity_match.close_pairs(left, right(0))))
    held = entity_match.scored(entity_match.close_pairs(left, right(1))).where("address_agrees is not null").withColumn("sure", entity_match.confidence(F.col("told"), curve))
    bins = held.groupBy(F.floor(F.col("sure") * 4)).agg(F.avg("sure"), F.avg(F.col("address_agrees").cast("double")), F.count("*")).collect()
    assert sum(abs(r[1] - r[2]) * r[3] for r in bins) / sum(r[3] for r in bins) < 0.08


def test_one_slip(spark):
    pairs = [("kernelo", "kenrelo", True), ("kernelo", "kerneloo", True), ("kernelo", "kernel", True), ("kernelo", "karnelo", True), ("kernelo", "karnela", False), ("abcd", "dcba", True), ("ab", "cd", False)]
    df = spark.createDataFrame([(a, b) for a, b, _ in pairs], "a string, b string")
    got = [r[0] for r in df.select(product_names.one_slip(F.col("a"), F.col("b"))).collect()]
    assert [g for g, p in zip(got, pairs) if p[:2] != ("abcd", "dcba")] == [p[2] for p in pairs if p[:2] != ("abcd", "dcba")]


def test_hamming_search_is_exact(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcde") for _ in range(rnd.randint(3, 7))) for _ in range(120)]
    df = spark.createDataFrame([(i, None, w, "z1", "") for i, w in enumerate(words)], "id bigint, maker string, family string, code string, suffix string").withColumn("short", F.lit(False)).withColumn("address_maker", F.lit(None).cast("string"))
    c = entity_match.classes(df).cache()
    got = {(r["a_family"], r["b_family"]) for r in entity_match.close_pairs(c, c).collect()}
    bits = {r["family"]: r["family_bits"] & (2**64 - 1) for r in c.collect()}
    assert got == {(a, b) for a in bits for b in bits if bin(bits[a] ^ bits[b]).count("1") <= entity_match.RADIUS}
    assert entity_match.close_pairs(c, c).count() == len(got)


def test_matching(spark):
    points = spark.createDataFrame(
        [(1, "Korvano", "Korvano Hulsel Z12A", "s", "w:korvano_cpus"), (2, "korvano", "Korvano Hulsel Z1234K", "s", "w"), (3, None, "KORVANO  Hulsel-Z1234K[2]", None, "w:korvano_cpus"), (4, "zandora", "Zandora Vista 555 Pro", "s", "w"), (5, None, None, None, None), (6, "braxosol", "Braxosol Vista 555 Pro", "s", "w")],
        "point_id bigint, manufacturer string, name string, slug string, source string",
    ).withColumn("candidate_id", F.lit("clash"))
    entries = spark.createDataFrame(
        [(11, "Hulsle Z1234-K processor (Korvano)", "u"), (12, "Kor. Hulsel Z1234 K", "u"), (13, "Hulsel Z1234KS", "u"), (14, "Vista 555Pro", "https://f.example/zandora/12"), (15, "Korvano (company)", "u"), (16, None, None), (17, "", "u"), (18, "Hulsel Z1234K", "https://f.example/braxosol/12"), (14, "Vista 555Pro", "https://f.example/zandora/12")],
        "candidate_id bigint, title string, url string",
    )
    out = entity_match.match_points(points, entries)
    assert {(r["point_id"], r["candidate_id"]) for r in out.collect()} == {(2, 11), (3, 11), (2, 12), (3, 12), (4, 14)}
    assert out.where("confidence between 0 and 1").count() == out.count()
    assert entity_match.match_points(points.limit(0), entries).count() == 0 and entity_match.match_points(points, entries.limit(0)).count() == 0


def test_isotonic():
    curve = entity_match.isotonic([(0.1, 5, 10), (0.2, 2, 10), (0.9, 9, 10)])
    assert [x for x, _ in curve] == [0.1, 0.9] and curve[0][1] < curve[1][1]


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rnd.randint(200, 260), rnd.randint(200, 260)) for _ in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame([e for a, b in edges for e in ((a, b), (b, a)) if a != b], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in incremental_dedup.components(df).collect()}
    assert got == {n: find(n) for n in got}


def _record(name, **more):
    import json

    return json.dumps({"name": name, **more})


def test_incremental_dedup(spark):
    phone = dict(ram_gb=8, storage_options_gb=[128])
    rows = [
        (1, 0, "cpu", "korvano", "hulsel-z1234k", _record("Korvano Hulsel Z1234K")),
        (2, 0, "cpu", "korvano", "hulsel-z1234k", _record("Korvano Hulsel Z1234KS")),
        (3, 0, "smartphone", "korvano", "vista-555-pro", _record("Vista 555 Pro 8GB 128GB", **phone)),
        (4, 1, "cpu", "korvano", "z1234k-hulsel", _record("KORVANO HULSLE Z1234K[2]")),
        (5, 1, "smartphone", "korvano", "vista-555-pro", _record("Vista 555 Pro", ram_gb="8", storage_options_gb=["128"])),
        (6, 1, "smartphone", "korvano", "vista-555-pro", _record("Vista 555 Pro", ram_gb=12, storage_options_gb=[128])),
        (7, 2, "cpu", "korvano", "hulssel-z1234k", _record("Hulssel Z1234K")),
        (8, 2, "gpu", "korvano", "hulsel-z1234k", _record("Korvano Hulsel Z1234K")),
        (9, 2, None, None, None, None),
        (10, None, "cpu", "korvano", "hulsel-z1234k", None),
        (11, 2, None, None, "", "{broken"),
        (4, 1, "cpu", "korvano", "z1234k-hulsel", _record("KORVANO HULSLE Z1234K[2]")),
    ]
    df = spark.createDataFrame(rows, "ingest_id bigint, batch_no int, category string, manufacturer string, slug string, record string").withColumn("node", F.lit("clash"))
    got = {r["ingest_id"]: r["first_id"] for r in incremental_dedup.link_batches(df).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 1, 5: 3, 6: 6, 7: 1, 8: 8, 9: 9, 10: 1, 11: 11}
    # Very long names too: keyed by their ends.
    long = [(i, 0, "cpu", "korvano", "", _record("Korvano " + w)) for i, w in enumerate(("ab" * 2_000, "ab" * 1_000 + "c" + "ab" * 1_000, "ab" * 2_000 + "ccc"), 1)]
    more = spark.createDataFrame(long, "ingest_id bigint, batch_no int, category string, manufacturer string, slug string, record string")
    assert {r["ingest_id"]: r["first_id"] for r in incremental_dedup.link_batches(more).collect()} == {1: 1, 2: 1, 3: 3}
    assert incremental_dedup.link_batches(df.limit(0)).count() == 0


def test_dedup_against_all_rows_at_once(spark):
    """Batch by batch gives what one batch of all rows gives."""
    df = spark.read.parquet(SF + "/ingest_candidates.parquet").where("ingest_id <= 600 or batch_no in (1, 9)")
    step = {(r[0], r[1]) for r in incremental_dedup.link_batches(df, turn_rows=0).collect()}
    assert step == {(r[0], r[1]) for r in incremental_dedup.link_batches(df).collect()}
    once = {(r[0], r[1]) for r in incremental_dedup.link_batches(df.withColumn("batch_no", F.lit(0))).collect()}
    assert step == once and any(a != b for a, b in step)


def test_tokenizer_round_trip(spark):
    enc = tokenizer.encoding(tokenizer.rank_file())
    rnd = random.Random(5)
    parts = ["foo", "bar  ", "été", "日本語", "1234", "don't", "\n\n", "😀", "<|endoftext|>"]
    docs = [(1, None), (2, ""), (3, "hello  world <|endoftext|> x"), (4, "a" * 5000), (5, " ".join(rnd.choice(parts) for _ in range(3000))), (6, " " * 4000 + "x"), (7, "x y " * 2000), (3, "hello  world <|endoftext|> x")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    for chunk, overlap, spread, more in ((1000, 100, 3000, 300), (257, 33, 500, 40), (tokenizer.CHUNK, tokenizer.OVERLAP, tokenizer.SPREAD, tokenizer.SPREAD_OVERLAP)):
        out = tokenizer.encode_corpus(df, chunk=chunk, overlap=overlap, spread=spread, spread_overlap=more)
        got = {r["doc_id"]: r["ids"] for r in out.collect()}
        assert got == {i: enc.encode_ordinary(t) if t else [] for i, t in docs} and out.count() == len(docs)
        data = {r["doc_id"]: bytes(r["data"]) for r in tokenizer.decode_corpus(out).collect()}
        assert data == {i: (t or "").encode() for i, t in docs}
    # A run without a boundary joins the chunks it crosses, and no others.
    run = " ".join("ab" for _ in range(400)) + "z" * 900 + " ab" * 400
    texts = df.limit(1).select(F.lit("k").alias("key"), F.lit(run).alias("text"))
    parts = tokenizer.pieces(texts, 300, 30).orderBy("at").collect()
    assert "".join(r["_text"] for r in parts) == run == "".join(tokenizer.stitched(run, 300, 30)) and len(parts) == len(tokenizer.stitched(run, 300, 30)) >= 6
    assert tokenizer.encode_corpus(df.limit(0)).count() == 0


def test_no_text_is_lost_whatever_its_id(spark):
    """Long and short texts of null and repeated ids give a row each."""
    enc = tokenizer.encoding(tokenizer.rank_file())
    rows = [(None, "a b " * 500), (None, "c d " * 600), (7, "e " * 900), (7, "f " * 900), (8, "x"), (8, "x"), (9, "g " * 900), (9, "g " * 900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = tokenizer.encode_corpus(df, chunk=100, overlap=10, spread=400, spread_overlap=40)
    key = lambda i, ids: (i or -1, ids)
    assert sorted(key(r["doc_id"], r["ids"]) for r in out.collect()) == sorted(key(i, enc.encode_ordinary(t)) for i, t in rows)
    counted = tokenizer.encode_corpus(df, counts=True, chunk=100, overlap=10, spread=400, spread_overlap=40)
    assert sorted(r["tokens"] for r in counted.collect()) == sorted(len(enc.encode_ordinary(t)) for _, t in rows)


def test_stitching_is_exact():
    """Random texts of blanks, letters and signs, at many chunk sizes."""
    enc, rnd = tokenizer.encoding(tokenizer.rank_file()), random.Random(11)
    for _ in range(150):
        text = "".join(rnd.choice(["a", "b", " ", "  ", "\n", "'s", "'", "1", "22", "é", "日", "!", "...", "\t "]) for _ in range(rnd.randint(1, 400)))
        chunk = rnd.randint(5, 60)
        assert [i for p in tokenizer.stitched(text, chunk, rnd.randint(1, chunk)) for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_tokenizer_equals_the_other_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{tokenizer.TOKENIZER_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    texts = ["A text, with 3 numbers 12 345.", "naïve <|endoftext|> café", "  spaces\n\nlines "]
    assert tokenizer.encode_texts(texts, tokenizer.rank_file()) == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_quotas():
    q = {x.source: x.quota for x in mixing.quotas([("a", 100, 0.5, 1), ("b", 1000, 0.3, 2), ("c", 1000, 0.2, 2), ("d", 0, 0.5, 3), ("e", 50, 0.0, 3)])}
    assert q["a"] == 100 and q["d"] == q["e"] == 0 and math.isclose(q["b"] / q["c"], 1.5) and math.isclose(sum(q.values()), 2100)


def test_flight_keeps_the_constraints():
    rnd = random.Random(2)
    for n in (1, 2, 3, 50, 400):
        size = [float(rnd.choice([0, 5, rnd.randint(1, 900)])) for _ in range(n)]
        p0 = [rnd.random() for _ in range(n)]
        p = mixing.flight(p0, size, "s")
        assert sum(0 < x < 1 for x in p) <= 2
        assert abs(sum(p) - sum(p0)) < 1e-6 * n and abs(sum(a * b for a, b in zip(p, size)) - sum(a * b for a, b in zip(p0, size))) < 1e-3 * n
        assert all(x in (0.0, 1.0) for x in mixing.landing(p, size))


def test_mix(spark):
    docs = spark.read.parquet(SF + "/documents.parquet").withColumn("tokens", F.lit("clash"))
    targets = spark.read.parquet(SF + "/mix_targets.parquet")
    chosen, shares = mixing.mix(docs, targets, block=64)
    rows = {r["source"]: r for r in shares.collect()}
    assert set(rows) == {r[0] for r in docs.select("source").distinct().collect()} | {r[0] for r in targets.select("source").collect()}
    assert rows["interview"]["share"] == rows["wiki_note"]["share"] == rows[None]["share"] == 0.0
    live = sum(r["target_share"] for r in rows.values() if r["documents"])
    for s, r in rows.items():
        if r["documents"] and r["target_share"] and r["used_tokens"] < 0.99 * r["available_tokens"] * r["max_repeats"]:
            assert abs(r["share"] - r["target_share"] / live) < 0.004, r
    assert chosen.join(targets, "source").where("copies > max_repeats or copies < 1").count() == 0
    empty_mix, empty_shares = mixing.mix(docs.limit(0), targets)
    assert empty_mix.count() == 0 and empty_shares.where("share = 0").count() == targets.count()
    assert mixing.mix(docs, targets.limit(0))[0].count() == 0


def test_index_is_exact():
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    skeletons = sorted({" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 8))) for _ in range(900)})
    idf = {t: 1 + rnd.random() for s in skeletons for t in content.terms(s)}
    index = content.Index(content.Examples(skeletons), idf, 3.0)
    vectors = [index.vector(s) for s in index.skeletons]
    for _ in range(40):
        q = " ".join(rnd.choice([*vocab, "unseen"]) for _ in range(rnd.randint(1, 8)))
        v = index.vector(q)
        every = np.array([sum(x * w.get(t, 0.0) for t, x in v.items()) for w in vectors])
        ids, sims = index.nearest(q)
        best = np.sort(every[every > 1e-9])[::-1][: content.NEIGHBOURS]
        assert np.allclose(sims, best, atol=1e-5) and np.allclose(every[ids], sims, atol=1e-5)
    assert len(index.nearest("unseen other")[0]) == 0


@pytest.mark.parametrize("a,b", [("you w.a.n.k.e.r!", "You WANKER"), ("an іdіоt", "an idiot"), ("so stuuuuupid", "so stupid"), ("wa​nker x", "wanker x"), ("1mbéc1l dos", "imbecil dos"), ("user77: it costs 5.5", "it costs 1,700"), ("like your Zandixa Arbeneth box", "like your Mirrora Vista 77 Pro Max box")])
def test_skeleton_sees_through_disguises(a, b):
    assert content.skeleton(a) == content.skeleton(b)


def test_passages():
    assert content.passages(None) == content.passages("") == content.passages(" \n ") == []
    assert content.passages("One. Two!\nThree") == ["One.", "Two!", "Three"]


def test_content(spark):
    """Held-out accuracy on invented documents, and the edges."""
    rnd = random.Random(7)
    fine = ["The battery lasts {n} hours.", "Shops list it from {n} dollars.", "The fan is loud under load.", "Version {n} fixes the bug.", "I would buy it again."]
    bad = ["You are a stupid clown.", "Nobody likes you, you pathetic clown.", "People from there are vermin."]
    docs, labels, truth = [], [], set()
    for i in range(400):
        lines = [rnd.choice(fine).format(n=rnd.randint(1, 99)) for _ in range(4)]
        if i % 8 == 0:
            truth.add(i)
            lines.insert(rnd.randint(0, 4), rnd.choice(bad))
        docs.append((i, " ".join(lines), rnd.choice(["a", "b", None])))
        if i < 200 and (i % 3 == 0 or i in truth):
            labels.append((i, int(i in truth) if rnd.random() > 0.1 else 1 - int(i in truth)))
    docs += [(900, None, "a"), (901, "", "a"), (902, "fine " * 30_000, "b"), (3, docs[3][1], docs[3][2])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, source string").withColumn("score", F.lit("clash"))
    lab = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id bigint, label int")
    out = content.score_corpus(d, lab)
    rows = out.collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if 200 <= r["doc_id"] < 400]
    assert sum(r["harmful"] == (r["doc_id"] in truth) for r in held) / len(held) > 0.95
    by = {r["doc_id"]: r for r in rows}
    assert by[900]["score"] == by[901]["score"] == 0.0 and not by[902]["harmful"]
    assert {r["source"]: r["documents"] for r in content.rates(out).collect()} == {s: sum(x[2] == s for x in docs) for s in ("a", "b", None)}
    flagged = [r for r in rows if r["harmful"]]
    assert {r["evidence_doc_id"] for r in flagged if r["evidence_doc_id"] is not None} <= {i for i, _ in labels} and any(r["evidence_doc_id"] is not None for r in flagged)
    assert all(r["passage"] and r["evidence"] for r in flagged)
    assert content.score_corpus(d, lab.limit(0)).where("harmful or score > 0").count() == 0
    assert content.score_corpus(d.limit(0), lab).count() == 0


def test_names_with_underscores(spark):
    """Underscores are blanks to every rule: ordinals, memory sizes and "5G" too."""
    table = {
        "Syvoevek_Iscorlo_194_3rd_gen": ("syvoevek", "iscorlo", "194", "gen3"),
        "Syvoevek Iscorlo 194 Gen 3": ("syvoevek", "iscorlo", "194", "gen3"),
        "Syvoevek_Iscorlo_1943rd__Gen": ("syvoevek", "iscorlo", "194", "gen3"),
        "Korvano_Vista_555_Pro_8GB_128GB": ("korvano", "vista", "555", "pro"),
        "Lumqano_Edgeline_611_5G": ("lumqano", "edgeline", "611", "5g"),
    }
    df = spark.createDataFrame(list(enumerate(table)), "i int, name string")
    got = {r["name"]: tuple(r["p"][f] for f in ("maker", "family", "code", "suffix")) for r in product_names.with_product(df, F.col("name")).collect()}
    assert got == table


def test_tokenizer_gives_a_row_for_each_long_row(spark):
    """Long rows with one id, equal or not, and without an id, are encoded like short ones."""
    enc = tokenizer.encoding(tokenizer.rank_file())
    a, b = "foo bar " * 300, "bar 12 " * 300
    docs = [(1, a, "s"), (1, b, "t"), (1, a, "u"), (None, a, "v"), (None, b, "w"), (None, "x", "x"), (2, None, "y")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    out = tokenizer.encode_corpus(df, chunk=500, overlap=50, keep=("source",)).collect()
    ids = lambda t: enc.encode_ordinary(t) if t else []
    assert {r["source"]: (r["doc_id"], r["ids"]) for r in out} == {s: (i, ids(t)) for i, t, s in docs} and len(out) == len(docs)
    plain = tokenizer.encode_corpus(df.drop("source"), chunk=500, overlap=50, counts=True).collect()
    assert sorted((r["doc_id"] or 0, r["tokens"]) for r in plain) == sorted((i or 0, len(ids(t))) for i, t, _ in docs)


def test_dedup_meets_every_spelling_of_a_key(spark):
    """The first spelling owns no key: a later one, two slips from it, still meets the right one."""
    rows = [(i, n, "cpu", "korvano", f"{w}-s194", _record(f"Korvano {w.title()} S194")) for i, n, w in ((1, 0, "dallselfi"), (2, 0, "dalselfi"), (3, 1, "dalsselfi"), (4, 2, "dalselfix"), (5, 2, "lumnorq"))]
    df = spark.createDataFrame(rows, "ingest_id bigint, batch_no int, category string, manufacturer string, slug string, record string")
    linker = incremental_dedup.Linker(spark)
    linker.weights = incremental_dedup.Weights({**incremental_dedup.DEFAULT.by_level, "family": [-20.0, 1.5, 0.5]}, 0.0)
    for n in range(3):
        linker.accept(df.where(f"batch_no = {n}"), n)
    assert {r["ingest_id"]: r["first_id"] for r in linker.representatives().collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5}


def test_dedup_is_taken_up_by_a_new_linker(spark, tmp_path):
    """A linker per batch, each on the folder of the last, gives what one linker gives; batches count once."""
    df = spark.read.parquet(SF + "/ingest_candidates.parquet").where("ingest_id <= 500 or batch_no in (1, 8, 9)")
    path = f"file://{tmp_path}/state"
    for n in (0, 1, 8, 9, 8):
        incremental_dedup.Linker(spark, path).accept(df.where(f"batch_no = {n}"), n)
    again = incremental_dedup.Linker(spark, path)
    assert again.done == {0, 1, 8, 9} and again.turns == 4 and again.weights is not None
    step = {tuple(r) for r in again.representatives().collect()}
    assert step == {tuple(r) for r in incremental_dedup.link_batches(df).collect()} and any(a != b for a, b in step)
    # A batch that broke off before it was done is taken in anew.
    again.parse(df.limit(3)).write.parquet(f"{path}/members/turn=4")
    assert {tuple(r) for r in incremental_dedup.Linker(spark, path).representatives().collect()} == step
    assert {tuple(r) for r in incremental_dedup.link_batches(df, path).collect()} == step


def test_a_small_batch_reads_its_buckets_only(spark, tmp_path):
    df = spark.read.parquet(SF + "/ingest_candidates.parquet")
    path = f"file://{tmp_path}/state"
    linker = incremental_dedup.Linker(spark, path)
    linker.accept(df.where("batch_no = 0"), 0)
    one = linker.parse(df.where("batch_no = 1").limit(1))
    touched = [r["bucket"] for r in one.collect()]
    whole, part = linker.table("keys"), linker.table("keys", touched)
    assert len(part.inputFiles()) == len(whole.inputFiles())  # before pruning
    files = part.select(F.input_file_name().alias("f")).distinct().count()
    assert files < whole.select(F.input_file_name().alias("f")).distinct().count() and "PartitionFilters: [isnotnull(bucket" in part._jdf.queryExecution().toString()


def test_blocking_loses_no_true_pair(spark):
    """Recall of the keys against all pairs of a block under the link rule's slips, by brute force."""
    df = spark.read.parquet(SF + "/ingest_candidates.parquet")
    rows = incremental_dedup.product_rows(df).groupBy(*incremental_dedup.FIELDS).agg(F.min("ingest_id").alias("node")).withColumn("bucket", F.lit(0)).cache()
    near = lambda x, y: ((F.col(x) != "") & (F.col(y) != "") & product_names.one_slip(F.col(x), F.col(y)))
    by = list(incremental_dedup.BLOCK)
    pairs = rows.alias("x").join(rows.alias("y"), [F.col(f"x.{n}") == F.col(f"y.{n}") for n in [*by, "maker"]]).where("x.node < y.node").where(near("x.family", "y.family")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    k = incremental_dedup.key_rows(rows)
    met = k.alias("x").join(k.alias("y"), ["key", "check"]).where("x.node < y.node").select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    assert pairs.count() > 50 and pairs.join(met, ["a", "b"], "left_anti").count() == 0


def test_content_on_held_out_labels(spark):
    """Fitted on the labels of every other document, held against the unanimous opinions on the rest."""
    d = "/root/testdata/sf0.1/"
    labels = spark.read.parquet(d + "content_labels.parquet")
    out = content.score_corpus(spark.read.parquet(d + "documents.parquet"), labels.where("doc_id % 2 = 0"))
    held = labels.where("doc_id % 2 = 1").groupBy("doc_id").agg(F.avg("label").alias("y"), F.count("*").alias("n")).where("n >= 2 and y in (0, 1)")
    rows = out.join(held, "doc_id").select("harmful", "y", "score").collect()
    hit = sum(r["harmful"] and r["y"] == 1 for r in rows)
    assert len(rows) > 100 and hit / sum(r["y"] == 1 for r in rows) >= 0.9 and hit / sum(r["harmful"] for r in rows) >= 0.9


def test_the_training_sample_is_bounded():
    """Harmful documents come first, the others in turn, whole documents only."""
    labelled = [(i, frozenset({f"l{i}", "x"}), float(i % 3 == 0)) for i in range(30)]
    kept, more = content.bounded(labelled, [frozenset({f"u{i}"}) for i in range(30)], 16)
    assert [i for i, _, y in kept if y] == list(range(0, 30, 3)) and len(set().union(*[s for _, s, _ in kept], *more)) <= 16 and kept and more


def test_an_id_in_many_rows_is_one_example(spark):
    """A labelled id that most rows repeat neither floods the sample nor changes what it says."""
    docs = [(i, f"You are a fool number {i % 3}." if i < 9 else f"The fan is fine on day {i}.", "a") for i in range(40)] + [(0, "You are a fool number 0.", "b")] * 300
    d = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, int(i < 9)) for i in range(0, 40, 2)], "doc_id bigint, label int")
    table = content.passage_table(d)
    labelled, others = content.training_documents(table, labels)
    assert len(labelled) == 20 and len(others) == 20
    out = content.score_corpus(d, labels)
    assert out.count() == len(docs) and {r["doc_id"] for r in out.where("harmful").collect()} == set(range(9))


def test_class_pairs_and_members_give_the_matches(spark):
    from specloom.llm import queries

    pairs, members = queries.p1_class_pairs(spark, SF), queries.p1_members(spark, SF)
    of = lambda side, c, i: members.where(f"side = '{side}'").select(F.col("class_id").alias(c), F.col("id").alias(i))
    joined = pairs.join(of("point", "a_class_id", "point_id"), "a_class_id").join(of("candidate", "b_class_id", "candidate_id"), "b_class_id").select("point_id", "candidate_id")
    found = queries.p1_found(spark, SF)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, found.select("point_id", "candidate_id").collect()))
    assert pairs.count() < found.count() * 2 and members.count() <= 2850
