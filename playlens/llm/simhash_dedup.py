"""SimHash near-duplicate detection with generalised pigeonhole probing.

Fingerprints: 64 bits; a bit is 1 if set in over half the XXH64 values of a
text's word shingles.  Two fingerprints link at ``max_bits`` or fewer
differing bits.

Search: the 64 bits are dealt into m partitions, correlated bits together.
If thresholds t_i (-1: partition not used) sum to ``max_bits - m + 1``, two
linked fingerprints differ in at most t_i bits in some partition i, so
probing every partition within its threshold loses no link.  The thresholds
are allocated by dynamic programming over estimated costs (probes written and
candidate pairs met), for several m, and the cheapest plan is taken.

Scale: equal fingerprints are collapsed first, so copies cost one row.  Large
groups of near copies are contracted before the full search: in every
partition each fingerprint is compared with the smallest one of its bucket
(linear work), and the full search then asks only for links between different
components.  A bucket that one component fills is kept apart from its other
members, so members of that component never meet each other again; compared
pairs are emitted only if they are links that join components.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import LOWER, materialize, pick
from playlens.llm.components import components

SEED = 42
#: Fingerprints in the bounded sample that the plan is fitted on (all are searched).
SAMPLE = 20_000
#: Buckets with more fingerprints than this keep their largest component apart.
LARGE = 64


def fingerprint(text: str | None, shingle: int) -> int:
    """Fingerprint as a signed 64-bit integer; no words: zero."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    k = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()][: len(words) - k + 1]
    stops = ends[k - 1:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for i in range(0, len(starts), 1 << 16):  # bounded memory for very long texts
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[i:i + (1 << 16)], stops[i:i + (1 << 16)])],
                     dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    ones = np.packbits(2 * counts > len(starts), bitorder="little")
    return int(ones.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(doc_id, fp)`` per row; null texts have no words."""
    slim = pick(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, fp long")


# ---- the plan: partitions and thresholds ---------------------------------

def _ones(sample: np.ndarray) -> np.ndarray:
    return np.unpackbits(sample.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)


def group_bits(sample: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of nearly equal width, correlated bits together."""
    x = _ones(sample) if len(sample) > 1 else np.zeros((2, 64))
    sd = x.std(axis=0)
    corr = np.abs(np.corrcoef(x[:, sd > 0], rowvar=False)) if (sd > 0).sum() > 1 else np.zeros((0, 0))
    full = np.zeros((64, 64))
    live = np.flatnonzero(sd > 0)
    if corr.ndim == 2 and len(corr) == len(live):
        full[np.ix_(live, live)] = corr
    left, out = list(range(64)), []
    for i in range(m):
        width = 64 // m + (i < 64 % m)
        first = max(left, key=lambda b: (full[b, left].sum(), -b))
        part = [first]
        left.remove(first)
        while len(part) < width:
            nxt = max(left, key=lambda b: (full[b, part].sum(), -b))
            part.append(nxt)
            left.remove(nxt)
        out.append(sorted(part))
    return out


def near_chance(p_equal: list[float], t: int) -> float:
    """Chance that two fingerprints differ in at most t of these bits."""
    dist = np.zeros(t + 1)
    dist[0] = 1.0
    for p in p_equal:
        dist = dist * p + np.concatenate([[0.0], dist[:-1]]) * (1 - p)
    return float(dist.sum())


def allocate(parts: list[list[int]], p_equal: np.ndarray, n: int, max_bits: int,
             probe_cost: float = 1.0, pair_cost: float = 0.02) -> tuple[float, list[int]]:
    """Thresholds (sum ``max_bits - m + 1``, at least -1 each) of least cost."""
    m = len(parts)

    def cost(bits: list[int], t: int) -> float:
        if t < 0:
            return 0.0
        probes = sum(_choose(len(bits), k) for k in range(t + 1))
        return n * (1 + probes) * probe_cost + n * n / 2 * near_chance([p_equal[b] for b in bits], t) * pair_cost

    total = max_bits - m + 1
    best = {0: (0.0, [])}  # sum of (t + 1) so far -> cost, thresholds
    for bits in parts:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t in range(-1, total + m - used):
                now = (c + cost(bits, t), [*ts, t])
                if used + t + 1 <= total + m and (used + t + 1 not in step or now[0] < step[used + t + 1][0]):
                    step[used + t + 1] = now
        best = step
    return best[total + m]


def _choose(n: int, k: int) -> int:
    import math

    return math.comb(n, k)


def make_plan(sample: np.ndarray, n: int, max_bits: int) -> list[tuple[list[int], int]]:
    """Partitions used, with their thresholds; the cheapest over several m."""
    ones = _ones(sample).mean(axis=0) if len(sample) else np.full(64, 0.5)
    p_equal = ones ** 2 + (1 - ones) ** 2
    plans = []
    for m in range(max(1, (max_bits + 2) // 2), max_bits + 2):
        parts = group_bits(sample, m)
        plans.append((*allocate(parts, p_equal, max(n, 2), max_bits), parts))
    _, ts, parts = min(plans, key=lambda x: x[0])
    return [(p, t) for p, t in zip(parts, ts) if t >= 0]


def _signed(bits) -> int:
    v = 0
    for b in bits:
        v |= 1 << b
    return v - (1 << 64) if v >= 1 << 63 else v


# ---- the search -------------------------------------------------------------

def _lit(v: int):
    return F.lit(v).cast("long")


def _probes(i: int, bits: list[int], t: int):
    """All keys of partition i within t bits of a fingerprint's own key."""
    own = F.col("fp").bitwiseAND(_lit(_signed(bits)))
    flips = [_signed(c) for r in range(t + 1) for c in itertools.combinations(bits, r)]
    return F.transform(F.array(*[_lit(v) for v in flips]),
                       lambda v: F.struct(F.lit(i).alias("p"), own.bitwiseXOR(v).alias("k")))


def _relabel(reps: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``reps`` with ``comp`` replaced by the component of ``comp`` under links."""
    cc = components(links, "a", "b", name)
    return (reps.join(cc.withColumnRenamed("node", "comp"), "comp", "left")
            .select("fp", F.coalesce("root", "comp").alias("comp")))


def fingerprint_components(fps: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, comp)`` for each distinct value of ``fp``: comp is the smallest
    fingerprint reachable by links of at most ``max_bits`` differing bits."""
    reps = materialize(fps.select("fp").distinct().withColumn("comp", F.col("fp")), "fp")
    n = reps.count()
    sample = reps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toPandas()["fp"].to_numpy(dtype=np.int64)
    plan = make_plan(sample, n, max_bits)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits

    # 1. each fingerprint against the smallest of its bucket, in every partition
    keyed = reps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("p"), F.col("fp").bitwiseAND(_lit(_signed(bits))).alias("k"))
        for i, (bits, _) in enumerate(plan)])).alias("s")).select("fp", "s.*")
    first = keyed.groupBy("p", "k").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = (keyed.withColumnRenamed("fp", "b").join(first.drop("n"), ["p", "k"])
             .where(near & (F.col("a") < F.col("b"))).select("a", "b"))
    reps = materialize(_relabel(reps, stars, "star"), "fp")

    # 2. all probes, for links between different components only
    index = reps.select("fp", "comp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("p"), F.col("fp").bitwiseAND(_lit(_signed(bits))).alias("k"))
        for i, (bits, _) in enumerate(plan)])).alias("s")).select("fp", "comp", "s.*")
    per = index.groupBy("p", "k", "comp").agg(F.count(F.lit(1)).alias("c"))
    large = materialize(per.groupBy("p", "k").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("n"))
                        .where(F.col("n") > LARGE).select("p", "k", F.col("top.comp").alias("full")), "large")
    probe = reps.select("fp", "comp", F.explode(F.flatten(F.array(*[
        _probes(i, bits, t) for i, (bits, t) in enumerate(plan)]))).alias("s")).select("fp", "comp", "s.*")
    if large.isEmpty():
        index, probe = index.withColumn("side", F.lit(0)), probe.withColumn("side", F.lit(0))
    else:
        index = (index.join(large, ["p", "k"], "left")
                 .withColumn("side", F.when(F.col("full") == F.col("comp"), 1).otherwise(0)).drop("full"))
        probe = (probe.join(large, ["p", "k"], "left")
                 .withColumn("side", F.explode(F.when(F.col("full").isNull() | (F.col("full") == F.col("comp")), F.array(F.lit(0)))
                                               .otherwise(F.array(F.lit(0), F.lit(1))))).drop("full"))
    left = probe.select(F.col("fp").alias("a"), F.col("comp").alias("ca"), "p", "k", "side")
    right = index.select(F.col("fp").alias("b"), F.col("comp").alias("cb"), F.col("p").alias("p2"),
                         F.col("k").alias("k2"), F.col("side").alias("side2"))
    # a component that fills a bucket is met from one side only, so both orders of a and b are kept
    links = (left.join(right, (F.col("p") == F.col("p2")) & (F.col("k") == F.col("k2")) & (F.col("side") == F.col("side2"))
                       & (F.col("ca") != F.col("cb")) & near)
             .select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct())
    return _relabel(reps, links, "probe")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 5, max_bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 lowercase
    hex digits), ``component_id`` (smallest id reachable by links).

    Null and empty texts have fingerprint zero and link like any other; rows
    with a null id keep their fingerprint and get the component's smallest
    non-null id; repeated rows are repeated; an empty table gives no rows;
    other columns are ignored.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash")
    comp = fingerprint_components(fps, max_bits)
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("low")).join(comp, "fp")
    roots = least.groupBy("comp").agg(F.min("low").alias("component_id"))
    named = least.join(roots, "comp").select("fp", "component_id")
    return (fps.join(named, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
