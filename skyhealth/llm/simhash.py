"""SimHash near-duplicates by the generalised pigeonhole principle.

Equal fingerprints are folded first. The 64 bits are dealt into parts that keep
correlated bits together, and each part gets a threshold of its own, from -1
(not probed) up, with a sum of ``bits - parts + 1``: any two fingerprints within
``bits`` then agree within the threshold on some probed part. Number of parts
and thresholds come from a dynamic program over the candidates and probes that
each choice would cost, estimated on a bounded sample; whatever it chooses, the
probes are complete. Every candidate is verified on all 64 bits inside the
join. Components of the links are found by star contraction.

Edge cases: documents without words (null or empty text) share fingerprint zero
and link like any other; a null doc_id is never a component's name unless the
component has no other; repeated rows keep a row each; a very long text is one
fingerprint like any other; an empty table gives no rows; only doc_id and text
are read.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyhealth.llm.common import staged
from skyhealth.llm.components import components
from skyhealth.llm.fingerprints import SHINGLE_WORDS, fingerprinted

MAX_BITS = 3
#: Fingerprints sampled to estimate candidates; the result never depends on it.
SAMPLE = 2048
MOST_PARTS = 8
LOWEST = -(1 << 63)
#: Cost of a verified candidate where a probe or index row costs 1.
CANDIDATE_COST = 0.05


def correlated_parts(bits: np.ndarray, parts: int) -> list[np.ndarray]:
    """Bit positions in ``parts`` groups of near-equal size. Each group starts
    at the free bit with the strongest tie and takes the free bit most
    correlated with it so far, again and again."""
    x = bits - bits.mean(axis=0) if len(bits) else bits
    scale = np.sqrt((x * x).sum(axis=0))
    tie = np.abs(x.T @ x) / np.maximum(np.outer(scale, scale), 1e-9)
    np.fill_diagonal(tie, 0)
    free, out = list(range(bits.shape[1])), []
    for p in range(parts):
        size = math.ceil(len(free) / (parts - p))
        own = [max(free, key=lambda b: (tie[b, free].max(), -b))]
        free.remove(own[0])
        while len(own) < size:
            best = max(free, key=lambda b: (tie[b, own].sum(), -b))
            own.append(best)
            free.remove(best)
        out.append(np.array(sorted(own)))
    return out


def ball(width: int, radius: int) -> int:
    return sum(math.comb(width, r) for r in range(radius + 1)) if radius >= 0 else 0


def part_costs(values: np.ndarray, width: int, n: int, bits: int) -> list[float]:
    """Cost of thresholds -1..bits on one part: index rows, probes, and the
    candidates estimated from the sample's own pairs (at least as many as
    evenly spread values would give)."""
    near = np.zeros(bits + 1)
    for i in range(0, len(values), 256):
        d = np.bitwise_count(values[i:i + 256, None] ^ values[None, :])
        near += [(d <= t).sum() for t in range(bits + 1)]
    pairs = max(1, len(values) * (len(values) - 1))
    near = (near - len(values)) / pairs
    costs = [0.0]
    for t in range(bits + 1):
        share = max(near[t], ball(width, t) / 2.0 ** width)
        costs.append(n + n * ball(width, t) + CANDIDATE_COST * share * n * n)
    return costs


def allocate(costs: list[list[float]], units: int) -> tuple[float, list[int]]:
    """Least total cost over the parts when the thresholds plus one add up to
    ``units``; returns it with the thresholds."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for k in range(min(units - used, len(own) - 1) + 1):
                new = cost + own[k], chosen + [k - 1]
                if used + k not in step or new < step[used + k]:
                    step[used + k] = new
        best = step
    return best[units]


def plan(sample: np.ndarray, n: int, bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """(mask, threshold) of the parts to probe, thresholds from 0 up."""
    shifts = np.arange(64, dtype=np.uint64)
    matrix = ((sample[:, None] >> shifts) & np.uint64(1)).astype(float)
    found = []
    for parts in range(1, MOST_PARTS + 1):
        groups = correlated_parts(matrix, parts)
        masks = [sum(1 << int(b) for b in g) for g in groups]
        costs = [part_costs(sample & np.uint64(m), len(g), n, bits) for m, g in zip(masks, groups)]
        cost, thresholds = allocate(costs, bits + 1)
        found.append((cost, [(m, t) for m, t in zip(masks, thresholds) if t >= 0]))
    return min(found)[1]


def flips(mask: int, radius: int) -> list[int]:
    """All changes of up to ``radius`` bits within a part."""
    bits = [b for b in range(64) if mask >> b & 1]
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in itertools.combinations(bits, r)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, parts: list[tuple[int, int]], bits: int = MAX_BITS) -> DataFrame:
    """a < b: the fingerprints (column ``fp``, distinct) that differ in at most
    ``bits`` bits; a pair may come from more than one part."""
    found = None
    for mask, radius in parts:
        value = F.col("fp").bitwiseAND(F.lit(signed(mask)))
        probes = fps.select(F.col("fp").alias("a"), value.alias("v"))
        if radius:
            probes = probes.select("a", "v", F.explode(F.array(*[F.lit(signed(m)) for m in flips(mask, radius)])).alias("m"))
            probes = probes.select("a", F.col("v").bitwiseXOR(F.col("m")).alias("v"))
        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
        pairs = probes.join(fps.select(F.col("fp").alias("b"), value.alias("v")).hint("merge"), "v")
        pairs = pairs.where((F.col("a") < F.col("b")) & near).select("a", "b")
        found = pairs if found is None else found.unionByName(pairs)
    return found


def sampled(fps: DataFrame) -> np.ndarray:
    rows = fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    return np.array([r.fp for r in rows], np.int64).view(np.uint64)


def near_duplicates(docs: DataFrame, keep: list[str], bits: int = MAX_BITS, size: int = SHINGLE_WORDS) -> DataFrame:
    """Every document: its ``keep`` columns, ``fingerprint`` and
    ``component_id`` (smallest doc_id of its component)."""
    marked = staged(fingerprinted(docs, list(dict.fromkeys(["doc_id", *keep])), size), "fingerprints")
    fps = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    found = links(fps, plan(sampled(fps), fps.count(), bits), bits)
    roots = components(found)
    named = fps.join(roots, fps.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(names, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        *keep, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, bits: int = MAX_BITS, size: int = SHINGLE_WORDS) -> DataFrame:
    """One document of each component stays, columns unchanged: the one the
    component is named after. Where rows share that doc_id (or all ids are
    null), one of them stays."""
    own = F.xxhash64("text")
    found = near_duplicates(docs.select("doc_id", "text", own.alias("h")), ["doc_id", "h"], bits, size)
    # A component is its name, or its fingerprint class where it has no name.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "h")).alias("w")
    named = found.where(F.col("component_id").isNotNull()).groupBy("component_id").agg(first)
    nameless = found.where(F.col("component_id").isNull()).groupBy("fingerprint").agg(first)
    winners = named.select("w").unionByName(nameless.select("w")).select(
        F.coalesce("w.doc_id", F.lit(LOWEST)).alias("_id"), F.col("w.h").alias("_h")).distinct()
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), F.coalesce(F.col("doc_id"), F.lit(LOWEST)).alias("_id"), own.alias("_h"))
    one = W.partitionBy("_id", "_h").orderBy(F.lit(1))
    return (keyed.join(winners, ["_id", "_h"]).withColumn("_n", F.row_number().over(one))
            .where(F.col("_n") == 1).select("d.*"))
