"""Mixing sources to target weights with balanced sampling.

Each source gets a quota of tokens: its target share of the budget, at most its own
tokens times max_repeats; what a full source cannot take goes to the others in proportion.
A quota is a whole number of copies of every document and a fraction of one more; which
documents get that one is drawn with the cube method: within blocks, fractional
probabilities move through the null space of the balancing constraints (documents and
tokens) until all but two of a block are 0 or 1; the rest goes into the next, coarser
blocks, and a last few are landed on the side nearest to the constraints.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from specloom.llm.tokenizer import encode_corpus
from specloom.session import cut

#: Documents in a block of the flight; a block is one task's memory.
BLOCK = 4096
SEED = 20240601


@dataclass(frozen=True)
class Quota:
    source: str
    tokens: int
    share: float
    repeats: int
    quota: float

    @property
    def copies(self) -> float:
        return min(self.quota / self.tokens, float(self.repeats)) if self.tokens else 0.0


def quotas(rows: list[tuple[str, int, float, int]], budget: float | None = None) -> list[Quota]:
    """Water filling over (source, tokens, share, repeats); the budget defaults to all tokens of these sources.

    Shares, repeats or tokens of 0 or less (or null) give a quota of 0.
    """
    live = {s: (t, w, r) for s, t, w, r in rows if t and t > 0 and w and w > 0 and r and r > 0}
    left = float(sum(t for t, _, _ in live.values()) if budget is None else budget)
    out, active = {}, dict(live)
    while active:
        weight = sum(w for _, w, _ in active.values())
        full = {s: t * r for s, (t, w, r) in active.items() if left * w / weight >= t * r}
        if not full:
            out |= {s: left * w / weight for s, (_, w, _) in active.items()}
            break
        for s, most in full.items():
            out[s] = float(most)
            left -= most
            del active[s]
        left = max(left, 0.0)
    return [Quota(s, t or 0, w or 0.0, r or 0, out.get(s, 0.0)) for s, t, w, r in rows]


def flight(prob: list[float], size: list[float], seed: str) -> list[float]:
    """Move probabilities until at most two are fractional; sums of p and of p times size stay.

    Works through the units with three of them in hand: the vector orthogonal to (1, 1, 1)
    and to the sizes is the way, and the step ends where one of the three is 0 or 1. The
    two steps' chances make the expected move nil.
    """
    rnd, eps = random.Random(seed), 1e-9
    p = list(prob)
    hand: list[int] = []
    for i in range(len(p)):
        if p[i] <= eps or p[i] >= 1 - eps:
            p[i] = float(round(p[i]))
            continue
        hand.append(i)
        while len(hand) == 3:
            a, b, c = (size[j] for j in hand)
            way = (c - b, a - c, b - a)
            if max(map(abs, way)) < eps:
                way = (1.0, -1.0, 0.0)
            up = min((1 - p[j]) / d if d > 0 else p[j] / -d for j, d in zip(hand, way) if d)
            down = min(p[j] / d if d > 0 else (1 - p[j]) / -d for j, d in zip(hand, way) if d)
            step = up if rnd.random() * (up + down) < down else -down
            for j, d in zip(hand, way):
                p[j] += step * d
                if p[j] <= eps or p[j] >= 1 - eps:
                    p[j] = 0.0 if p[j] <= eps else 1.0
            hand = [j for j in hand if 0.0 < p[j] < 1.0]
    return p


def landing(prob: list[float], size: list[float]) -> list[float]:
    """The few fractional ones rounded so that tokens, then documents, miss least."""
    open_ = [i for i, x in enumerate(prob) if 0.0 < x < 1.0]
    assert len(open_) <= 8
    best, p = None, list(prob)
    for mask in range(2 ** len(open_)):
        pick = [mask >> k & 1 for k in range(len(open_))]
        miss = (abs(sum((x - prob[i]) * size[i] for x, i in zip(pick, open_))), abs(sum(x - prob[i] for x, i in zip(pick, open_))))
        if best is None or miss < best[0]:
            best = (miss, pick)
    for x, i in zip(best[1], open_):
        p[i] = float(x)
    return p


def cube_sample(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """(source, doc_id, tokens, pick) of units (source, doc_id, tokens, prob, blocks).

    ``blocks`` is the number of blocks of the unit's source. A source of any size is spread
    over its blocks; each level leaves two units of a block, so levels are few.
    """

    def fly(last: bool):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["doc_id", "tokens"], kind="stable")
            source, group = pdf["source"].iloc[0], int(pdf["group"].iloc[0])
            size = [float(x) for x in pdf["tokens"]]
            p = flight([float(x) for x in pdf["prob"]], size, f"{SEED}|{source}|{group}|{len(size)}")
            return pdf.assign(prob=landing(p, size) if last else p)

        return run

    schema = "source string, doc_id bigint, tokens bigint, prob double, blocks int, group int"
    columns = [c.split()[0] for c in schema.split(", ")]
    now = units.withColumn("group", F.pmod(F.xxhash64("doc_id"), F.col("blocks").cast("bigint")).cast("int")).select(*columns)
    most = units.agg(F.coalesce(F.max("blocks"), F.lit(1)).alias("m")).first()["m"]
    done = None
    while True:
        flown = cut(now.groupBy("source", "group").applyInPandas(fly(most <= 1), schema), "mix-flight")
        settled = flown.where("prob = 0 or prob = 1")
        done = settled if done is None else done.unionByName(settled)
        if most <= 1:
            return done.select("source", "doc_id", "tokens", F.col("prob").cast("int").alias("pick"))
        per = max(block // 2, 2)
        most = -(-most // per)
        now = flown.where("prob > 0 and prob < 1").withColumn("group", F.floor(F.col("group") / per).cast("int")).select(*columns)


def mix(documents: DataFrame, targets: DataFrame, budget: float | None = None, path: str | None = None, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The mix (doc_id, source, tokens, copies) and the shares reached per source.

    Only documents with copies are in the mix. Shares have one row per source of either
    table; a source without documents, without target or without name (null) has 0. Null
    and empty texts count 0 tokens and are drawn like others. A target named twice has the
    sum of its shares and the least of its repeats. Rows that repeat a doc_id are drawn each
    and their copies add up.
    """
    docs = cut(encode_corpus(documents, path, counts=True, keep=("source",)), "mix-tokens")
    wanted = targets.where("source is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
    per_source = docs.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("available_tokens"))
    # One row per named target comes to the driver.
    rows = wanted.join(per_source, "source").select("source", "available_tokens", "target_share", "max_repeats", "documents").collect()
    plan = {q.source: q for q in quotas([(r[0], r[1], r[2], r[3]) for r in rows], budget)}
    count = {r["source"]: r["documents"] for r in rows}
    spark = docs.sparkSession
    parts = [(s, int(q.copies), q.copies - int(q.copies), max(1, -(-count[s] // block))) for s, q in plan.items() if q.copies > 0]
    ways = spark.createDataFrame(parts, "source string, base int, prob double, blocks int")
    units = docs.join(F.broadcast(ways), "source")
    picked = cube_sample(units.where("prob > 0").select("source", "doc_id", "tokens", "prob", "blocks"), block).select("source", "doc_id", "tokens", "pick")
    base = units.where("base > 0").select("source", "doc_id", "tokens", F.col("base").alias("pick"))
    chosen = picked.unionByName(base).where("pick > 0").groupBy("doc_id", "source", "tokens").agg(F.sum("pick").cast("int").alias("copies"))
    used = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("used_tokens"))
    every = per_source.select("source").union(wanted.select("source")).distinct()
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    shares = (
        every.alias("e")
        .join(wanted.alias("w"), same("e", "w"), "left")
        .join(per_source.alias("p"), same("e", "p"), "left")
        .join(used.alias("u"), same("e", "u"), "left")
        # One row per source: a window over all of them is small.
        .withColumn("total", F.sum("u.used_tokens").over(Window.partitionBy()))
        .select(
            F.col("e.source").alias("source"),
            F.coalesce("target_share", F.lit(0.0)).alias("target_share"),
            F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"),
            F.coalesce("documents", F.lit(0)).cast("bigint").alias("documents"),
            F.coalesce("available_tokens", F.lit(0)).cast("bigint").alias("available_tokens"),
            F.coalesce("used_tokens", F.lit(0)).cast("bigint").alias("used_tokens"),
            F.when(F.col("total") > 0, F.coalesce("used_tokens", F.lit(0)) / F.col("total")).otherwise(F.lit(0.0)).alias("share"),
        )
    )
    return chosen, shares
