"""Abusive, hateful or sexual content by nearest labelled examples.

Texts are split into passages; passages and labelled examples become TF-IDF vectors of
normalised words and word pairs. The nearest examples of a passage are found exactly by
cosine with an inverted index whose postings lie in blocks of examples with a bound per
block: blocks that cannot reach the k-th best similarity are skipped. Votes weighted by
similarity give a score; scores are calibrated on the labelled documents, each judged
without its own examples. Every distinct passage of the corpus is scored once, however
many documents repeat it.

A label stands for a document, not for a passage. So an example is a passage with the
number of labelled documents, and of harmful ones, in which it stands: what is common to
all documents votes with the base rate, what stands in harmful documents only votes
harmful.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.llm.entity_match import confidence, curve_points
from specloom.session import cut

#: Bound on the labelled documents whose passages are examples, per class. This bounds the
#: index that every task holds; it is a classifier's training sample.
MAX_LABELLED = 3000
NEIGHBOURS = 10
POWER = 4
#: Documents of the base rate that every example's own count is joined with.
PRIOR = 0.3
#: Weight of the base rate against all neighbours of a passage.
SHRINK = 0.03
#: An unlabelled document counts as this many labelled ones.
UNLABELLED = 1.0
BLOCK = 64
#: Terms in at least this share of the examples are kept as matrix rows.
DENSE = 0.02
#: Share of harm an unlabelled document starts with, and rounds of training.
START = 0.03
ROUNDS = 3
#: Blocks scored first, for the similarity that others must reach.
HEAD = 4
#: Bounds of the training sample: documents with more passages are no examples, as a label
#: then hardly says which passage it means, and documents are taken up to so many examples.
MAX_PASSAGES = 200
MAX_EXAMPLES = 40_000
#: Distinct passages a task remembers the scores of.
REMEMBERED = 200_000

_ZERO_WIDTH = dict.fromkeys([0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF])
# Letters of other scripts that look like Latin ones, and signs that stand for letters.
_LOOKALIKE = str.maketrans("аеорсухіјѕһԁԛԝѵкмтвнгАЕОРСУХІЈЅНКМТВ", "aeopcyxijshdqwvkmtbhrAEOPCYXIJSHKMTB")
_SIGNS = str.maketrans("013457@$!|", "oieastasil")
_END = re.compile(r"(?<=[.!?…。！？])[\"”»“«'’)]*\s+|[\n\r]+|(?<=[。！？])")
# A capitalised word with such words, short capitals or numbers after it; who speaks, at the start of a line: a mention,
# a word with a colon, letters with a long number.
_NAME = re.compile(r"\b[A-ZÀ-Þ][a-zà-ÿ]+(?:[ -]+(?:[A-ZÀ-Þ][a-zà-ÿ][\wà-ÿ]*|[A-Z]{1,3}\b|[A-Z]{0,3}\d+\w*))+")
_NAMES = re.compile(r"qname(?:\s+qname\b)+")
_SPEAKER = re.compile(r"^(?:[-*>#•]+\s*|@\w+\s*:?\s*|\w+(?:[ _#]?\d+)?\s*:\s+|[A-Za-z]+\d{3,}\s+)+")
_SPACED = re.compile(r"(?<![^\W_])((?:[^\W\d_][ .\-_*]){3,}[^\W\d_])(?![^\W_])")
_RUN = re.compile(r"(.)\1{2,}")
_TOKEN = re.compile(r"[^\W_][\w@$!*#|'’]*[^\W_]|[^\W_]", re.UNICODE)
_DISGUISED = re.compile(r"(?=(?:.*[a-z]){2})[a-z0-9@$!*#|'’]{3,}")
_MEASURE = re.compile(r"[a-z]?\d+[a-z]{0,4}|[a-z]+\d{3,}")
_NUMBER = re.compile(r"(?<![^\W_])\d+(?:[.,:]\d+)*(?![^\W_])")


def passages(text: str | None) -> list[str]:
    """A text's sentences and lines."""
    if not text:
        return []
    return [s for s in (x.strip() for x in _END.split(text)) if s]


def _word(w: str) -> str:
    """One word in plain letters: signs and digits inside letters read as letters, other digits as 0."""
    if _DISGUISED.fullmatch(w) and not _MEASURE.fullmatch(w):
        return w.translate(_SIGNS)
    return re.sub(r"\d+", "0", w)


def skeleton(passage: str) -> str:
    """A passage without what varies: speakers, names, numbers, disguises of letters, long runs.

    Capitalised words in a row, or one before a number, are a name.
    """
    s = passage
    if not s.isascii():
        s = unicodedata.normalize("NFKD", s.translate(_ZERO_WIDTH))
        s = "".join(c for c in s if not unicodedata.combining(c)).translate(_LOOKALIKE)
    s = _SPEAKER.sub("", s)
    s = _SPACED.sub(lambda m: re.sub(r"[ .\-_*]", "", m[1]), s)
    s = _NAMES.sub("qname", _NAME.sub(" qname ", s)) if not s.isupper() else s
    words = [w if w.isalpha() else _word(w) for w in _TOKEN.findall(_NUMBER.sub("0", s.lower()))]
    s = " ".join(words)
    return " ".join(_RUN.sub(r"\1", w) if len(w) > 3 else w for w in words) if _RUN.search(s) else s


def terms(skel: str) -> list[str]:
    """Words and pairs of words in a row, with the ends marked."""
    w = skel.split()
    return w + [f"{a} {b}" for a, b in zip(["^", *w], [*w, "$"])]


@dataclass
class Examples:
    """Distinct passages."""

    skeletons: list[str]


class Index:
    """Block-max inverted index over the examples; search is exact."""

    def __init__(self, examples: Examples, idf: dict[str, float], default_idf: float) -> None:
        self.idf, self.default_idf = idf, default_idf
        # Skeletons are sorted, so examples that share words lie near each other and bounds are sharp.
        order = sorted(range(len(examples.skeletons)), key=lambda i: examples.skeletons[i])
        self.skeletons = [examples.skeletons[i] for i in order]
        #: Documents, and harmful ones, in which each example stands.
        self.total = np.zeros(len(order))
        self.harmful = np.zeros(len(order))
        self.blocks = -(-len(order) // BLOCK)
        by_term: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for i, s in enumerate(self.skeletons):
            for t, w in self.vector(s).items():
                by_term[t].append((i, w))
        n = len(order)
        # Postings of frequent terms are kept as rows of a matrix, of rare ones as lists.
        frequent = [t for t, p in by_term.items() if len(p) >= max(DENSE * n, 8)]
        rare = [t for t, p in by_term.items() if len(p) < max(DENSE * n, 8)]
        self.row = {t: k for k, t in enumerate(frequent)}
        self.list = {t: k for k, t in enumerate(rare)}
        width = self.blocks * BLOCK
        self.matrix = np.zeros((len(frequent), width), dtype=np.float32)
        for k, t in enumerate(frequent):
            ids, w = zip(*by_term[t])
            self.matrix[k, list(ids)] = w
        self.row_bound = self.matrix.reshape(len(frequent), self.blocks, BLOCK).max(axis=2) if n else np.zeros((0, 0), dtype=np.float32)
        # By block, so that one block's rows are read in runs.
        self.matrix = np.ascontiguousarray(self.matrix.reshape(len(frequent), self.blocks, BLOCK).transpose(1, 0, 2))
        #: Per rare term: examples and weights.
        self.postings = [(np.array([i for i, _ in by_term[t]], dtype=np.int32), np.array([w for _, w in by_term[t]], dtype=np.float32)) for t in rare]
        #: Per example, where known, a labelled document in which it stands, a harmful one first.
        self.documents: list[int | None] = [None] * len(order)

    def vector(self, skel: str) -> dict[str, float]:
        """Unit TF-IDF vector; words no example has count in the length."""
        v = {t: (1 + math.log(c)) * self.idf.get(t, self.default_idf) for t, c in Counter(terms(skel)).items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {t: x / norm for t, x in v.items()}

    def nearest(self, skel: str, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples and their cosines, exactly; ties go to the lower number.

        Postings of rare terms are summed per example, so a block's bound is the best of
        these sums and the greatest the frequent terms can add in that block. The blocks
        with the greatest bounds are scored first; of the others only those whose bound
        reaches the k-th similarity found there.
        """
        v = self.vector(skel)
        rows = [(self.row[t], x) for t, x in v.items() if t in self.row]
        lists = [(self.list[t], x) for t, x in v.items() if t in self.list]
        n = len(self.skeletons)
        if not rows and not lists:
            return np.array([], dtype=int), np.array([])
        width = self.blocks * BLOCK
        if lists:
            found = [self.postings[i] for i, _ in lists]
            part = np.concatenate([f[1] * np.float32(x) for f, (_, x) in zip(found, lists)])
            rare = np.bincount(np.concatenate([f[0] for f in found]), part, width).reshape(self.blocks, BLOCK)
        else:
            rare = np.zeros((self.blocks, BLOCK))
        bound = rare.max(axis=1)
        row_no = np.array([r for r, _ in rows], dtype=int)
        row_x = np.array([x for _, x in rows], dtype=np.float32)
        if rows:
            bound = bound + row_x @ self.row_bound[row_no]

        def scored(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Examples of some blocks and their cosines."""
            out = rare[blocks]
            if rows:
                out = out + np.matmul(row_x, self.matrix[blocks[:, None], row_no])
            return (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel(), out.ravel()

        first = np.argpartition(-bound, HEAD)[:HEAD] if self.blocks > HEAD else np.arange(self.blocks)
        at, scores = scored(first)
        if self.blocks > HEAD:
            reached = np.partition(scores, -k)[-k]
            more = bound >= reached - 1e-6
            more[first] = False
            if more.any():
                at2, scores2 = scored(np.nonzero(more)[0])
                at, scores = np.concatenate([at, at2]), np.concatenate([scores, scores2])
        found = np.nonzero((scores > 1e-9) & (at < n))[0]
        if len(found) > k:
            found = found[scores[found] >= np.partition(scores[found], -k)[-k]]
        found = found[np.lexsort((at[found], -scores[found]))[:k]]
        return at[found], scores[found].astype(float)

    def weigh(self, ids: np.ndarray, sims: np.ndarray, base: float, mine: np.ndarray | None = None, own_share: float = 0.0, own_weight: float = 1.0) -> tuple[float, int]:
        """(score, place of the best example) of neighbours.

        Neighbours marked in ``mine`` lose the document they are judged for: it does not vote
        for itself. Far neighbours fade; many documents count with a diminishing weight.
        """
        h, n = self.harmful[ids], self.total[ids]
        if mine is not None:
            h, n = np.maximum(h - own_weight * own_share * mine, 0), np.maximum(n - own_weight * mine, 0)
        w = np.minimum(sims, 1.0) ** POWER * np.log2(1.0 + n)
        rate = (h + base * PRIOR) / (n + PRIOR)
        return (float(np.dot(w, rate)) + SHRINK * base) / (float(w.sum()) + SHRINK), int(np.argmax(w * rate))

    def vote(self, skel: str, base: float) -> tuple[float, int]:
        """(score, best example or -1) of a passage."""
        ids, sims = self.nearest(skel)
        if not len(ids):
            return base, -1
        score, best = self.weigh(ids, sims, base)
        return score, int(ids[best])


@dataclass
class Model:
    index: Index
    base: float
    curve: list[tuple[float, float]]
    threshold: float


def passage_table(documents: DataFrame) -> DataFrame:
    """(row, doc_id, source, passages, skeletons) of every row, written once; null and empty texts have none."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, str] = {}
        for batch in batches:
            text, kept = batch.column("text"), [batch.column(n) for n in ("doc_id", "source")]
            for at in range(0, batch.num_rows, 1024):  # bounds what one batch holds in Python
                found = [passages(t) for t in text.slice(at, 1024).to_pylist()]
                skels = []
                for some in found:
                    for p in some:
                        if p not in seen:
                            if len(seen) >= REMEMBERED:
                                seen.clear()
                            seen[p] = skeleton(p)
                    skels.append([seen.get(p) or skeleton(p) for p in some])
                strings = pa.list_(pa.string())
                yield pa.RecordBatch.from_arrays([*[c.slice(at, 1024) for c in kept], pa.array(found, strings), pa.array(skels, strings)], ["doc_id", "source", "passages", "skeletons"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), "text").mapInArrow(read, "doc_id bigint, source string, passages array<string>, skeletons array<string>")
    return cut(rows.select(F.monotonically_increasing_id().alias("row"), "*"), "content-passages")


def training_documents(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> tuple[list[tuple[int, frozenset[str], float]], list[frozenset[str]]]:
    """(doc_id, skeletons, share of harmful opinions) of labelled documents, and skeletons of others.

    At most ``most`` documents of either label and as many without one, drawn by the hash of
    their id, none with more than MAX_PASSAGES; of several texts of one id one is taken.
    Null opinions do not count.
    """
    voted = labels.where("label is not null").groupBy("doc_id").agg(F.avg(F.col("label").cast("double")).alias("share"))
    some = docs.where(F.size("skeletons").between(1, MAX_PASSAGES)).select("doc_id", F.array_distinct("skeletons").alias("skeletons"))

    def drawn(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))

    chosen = drawn(voted.where("share >= 0.5")).unionByName(drawn(voted.where("share < 0.5")))
    # One text an id: an id that many rows repeat comes to the driver once.
    once = F.min("skeletons").alias("skeletons")
    rows = some.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "share").agg(once).collect()
    known = {r["doc_id"] for r in rows}
    # The draw carries ids only; the labelled among them, a few, are left out here.
    more = some.join(drawn(some.where("doc_id is not null").select("doc_id").distinct()), "doc_id").groupBy("doc_id").agg(once).collect()
    skels = lambda r: frozenset(s for s in r["skeletons"] if s)
    order = lambda r: (r["doc_id"], r["skeletons"])
    return [(r["doc_id"], skels(r), r["share"]) for r in sorted(rows, key=order) if skels(r)], [skels(r) for r in sorted(more, key=order) if r["doc_id"] not in known and skels(r)]


def bounded(labelled: list, unlabelled: list, most: int = MAX_EXAMPLES) -> tuple[list, list]:
    """The documents, harmful ones first and then of either kind in turn, that fit into ``most`` examples."""
    harmful, rest = [x for x in labelled if x[2] >= 0.5], [x for x in labelled if x[2] < 0.5]
    turns = [("l", x, x[1]) for x in harmful]
    for i in range(max(len(rest), len(unlabelled))):
        turns += [("l", x, x[1]) for x in rest[i : i + 1]] + [("u", x, x) for x in unlabelled[i : i + 1]]
    examples: set[str] = set()
    out: dict[str, list] = {"l": [], "u": []}
    for kind, x, skels in turns:
        if len(examples | skels) > most:
            break
        examples |= skels
        out[kind].append(x)
    return out["l"], out["u"]


def term_frequencies(distinct: DataFrame, vocabulary: frozenset[str]) -> tuple[dict[str, int], int]:
    """In how many passages each term of the vocabulary stands, over the whole corpus.

    ``distinct`` has (skeleton, n). Each task counts the vocabulary's terms, so what is
    shuffled and collected is bounded by the vocabulary, and that by the training sample.
    """
    shared = distinct.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c: Counter = Counter()
        total, vocab = 0, shared.value
        for pdf in batches:
            for skel, n in zip(pdf["skeleton"], pdf["n"]):
                total += n
                for t in vocab.intersection(terms(skel)):
                    c[t] += n
        yield pd.DataFrame({"term": ["", *c.keys()], "n": [total, *c.values()]})

    rows = distinct.mapInPandas(count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counted = {r["term"]: r["n"] for r in rows}
    total = counted.pop("", 0)
    return counted, total


def calibrate(points: list[tuple[float, float, float]]) -> tuple[list[tuple[float, float]], float]:
    """Calibration curve over (score, label share, weight), and the raw threshold with the best F1."""
    if not points:
        return [(0.0, 0.0)], 0.5
    binned: dict[float, list[float]] = {}
    for x, y, w in points:
        b = binned.setdefault(round(x, 3), [0.0, 0.0])
        b[0] += y * w
        b[1] += w
    curve = curve_points([(x, p, n) for x, (p, n) in binned.items()])
    truth = sum(w for _, y, w in points if y >= 0.5)
    hit = said = 0.0
    best, threshold = -1.0, 0.5
    ranked = sorted(points, reverse=True)
    for i, (x, y, w) in enumerate(ranked):
        said += w
        hit += w * (y >= 0.5)
        if i + 1 < len(ranked) and ranked[i + 1][0] == x:
            continue
        f1 = 2 * hit / (said + truth)
        if f1 > best:
            best = f1
            threshold = (x + ranked[i + 1][0]) / 2 if i + 1 < len(ranked) else x
    return curve, threshold


def train(labelled: list[tuple[int, frozenset[str], float]], unlabelled: list[frozenset[str]], idf: dict[str, float], default_idf: float, rounds: int = ROUNDS) -> Model:
    """The model of passages of labelled and unlabelled documents.

    Labelled samples hold more harm than the corpus, and few of them leave it open which of
    a document's passages is meant. Unlabelled documents settle that: they start with a
    small share, so a passage that is common everywhere votes harmless, and in each round
    they take the side the last round put them on.
    """
    every = [s for _, s, _ in labelled] + unlabelled
    share = np.array([y for _, _, y in labelled] + [START] * len(unlabelled))
    weight = np.array([1.0] * len(labelled) + [UNLABELLED] * len(unlabelled))
    index = Index(Examples(sorted(set().union(*every))), idf, default_idf)
    place = {s: i for i, s in enumerate(index.skeletons)}
    where = [np.array(sorted(place[s] for s in skels), dtype=int) for skels in every]
    for (doc, skels, _), at in sorted(zip(labelled, where), key=lambda x: x[0][2]):
        for i in at:
            index.documents[i] = doc
    near = [index.nearest(s) for s in index.skeletons]
    # Which neighbours of a document's passages are its own.
    mine = [[np.isin(near[i][0], at) for i in at] for at in where]
    first, last = len(labelled), len(every)
    curve, threshold, base = [(0.0, 0.0)], 0.5, START
    for _ in range(rounds):
        index.harmful, index.total = np.zeros(len(place)), np.zeros(len(place))
        for at, y, w in zip(where, share, weight):
            index.harmful[at] += w * y
            index.total[at] += w
        base = float(share[first:last].mean()) if last > first else float(share[:first].mean())
        raw = np.array([max((index.weigh(*near[i], base, m, share[d], weight[d])[0] for i, m in zip(where[d], mine[d])), default=0.0) for d in range(last)])
        given = share[:first]
        # The labelled sample counted as the corpus would: harm at the base rate.
        up, down = base / max(given.mean(), 1e-9), (1 - base) / max(1 - given.mean(), 1e-9)
        curve, threshold = calibrate([(float(x), float(y), up if y >= 0.5 else down) for x, y in zip(raw[:first], given)])
        share[first:last] = [1.0 if x >= threshold else START for x in raw[first:last]]
    return Model(index, base, curve, threshold)


def fit(docs: DataFrame, distinct: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> Model | None:
    """The model of a corpus (as ``passage_table`` has it) and its labels; None without any labelled passage."""
    labelled, unlabelled = bounded(*training_documents(docs, labels, most))
    if not labelled:
        return None
    vocabulary = frozenset(t for s in set().union(*[s for _, s, _ in labelled], *unlabelled) for t in terms(s))
    df, n = term_frequencies(distinct, vocabulary)
    return train(labelled, unlabelled, {t: math.log((n + 1) / (c + 0.5)) for t, c in df.items()}, math.log((n + 1) / 0.5))


def score_corpus(documents: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, source, score, harmful, passage, evidence, evidence_doc_id) of every document.

    ``score`` is a calibrated probability, ``passage`` the worst passage, ``evidence`` the
    example that speaks most for it and ``evidence_doc_id`` a labelled document with it
    (null for an example of unlabelled ones). Null and empty texts have score 0; without
    labels every score is 0. The fit is a bounded sample of the labels; counts and search
    run over all. Distinct passages are scored, so a passage in a third of all documents is
    one search, and documents take the worst of their passages.
    """
    c = F.col
    docs = passage_table(documents)
    parts = docs.select("row", F.posexplode("skeletons").alias("pos", "skeleton")).where("skeleton <> ''")
    distinct = cut(parts.groupBy("skeleton").agg(F.count(F.lit(1)).alias("n")), "content-skeletons")
    model = fit(docs, distinct, labels, most)
    if model is None:
        return docs.select("doc_id", "source", F.lit(0.0).alias("score"), F.lit(False).alias("harmful"), F.lit("").alias("passage"), F.lit("").alias("evidence"), F.lit(None).cast("bigint").alias("evidence_doc_id"))
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)  # at most MAX_EXAMPLES examples

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            found = [m.index.vote(s, m.base) for s in pdf["skeleton"]]
            yield pd.DataFrame({"key": pdf["key"], "raw": [x for x, _ in found], "example": [i for _, i in found]})

    votes = distinct.select(F.xxhash64("skeleton").alias("key"), "skeleton").repartition(spark.sparkContext.defaultParallelism * 2, "key").mapInPandas(vote, "key bigint, raw double, example int")
    # The worst passage, the first of equals. The vector's key stands for the passage's text.
    worst = parts.select("row", "pos", F.xxhash64("skeleton").alias("key")).join(votes, "key").groupBy("row").agg(F.max(F.struct("raw", -c("pos"), "example")).alias("w"))
    worst = worst.select("row", c("w.raw").alias("raw"), (-c("w.col2")).alias("pos"), c("w.example").alias("example"))
    examples = spark.createDataFrame([(i, s, d) for i, (s, d) in enumerate(zip(model.index.skeletons, model.index.documents))], "example int, evidence string, evidence_doc_id bigint")
    scored = docs.join(worst, "row", "left").join(F.broadcast(examples), "example", "left")  # at most MAX_EXAMPLES rows
    return scored.select(
        "doc_id",
        "source",
        F.when(c("raw").isNotNull(), F.round(confidence(c("raw"), model.curve), 6)).otherwise(F.lit(0.0)).alias("score"),
        F.coalesce(c("raw") >= model.threshold, F.lit(False)).alias("harmful"),
        F.coalesce(F.get("passages", c("pos")), F.lit("")).alias("passage"),
        F.coalesce("evidence", F.lit("")).alias("evidence"),
        "evidence_doc_id",
    )


def rates(scored: DataFrame) -> DataFrame:
    """Per source (null is one): documents, harmful ones, their rate and the mean score."""
    return scored.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if("harmful").alias("harmful_documents"), F.avg(F.col("harmful").cast("double")).alias("rate"), F.avg("score").alias("mean_score")
    )
