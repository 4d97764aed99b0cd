"""Audit of how far the sources of a language differ, by hash-consed segment trees.

Every (lang, source) group is a vector of term counts, held as a segment tree
over term ids. Equal subtrees, wherever they lie and whichever group they are
of, are one node. Two groups are compared by walking both trees at once from
their roots; a pair of nodes that the walk meets again is priced once, times
the number of its occurrences. As ids go by falling count, the rare terms'
subtrees are mostly empty, and a pair of empty nodes costs one step a level.

How it runs: workers count terms per group over whole texts and Spark adds the
counts up. Terms are dealt by hash into buckets of about ``BUCKET_ROWS`` counts
of a language; a bucket is one subtree of every group of the language and one
task's work, which sends on one partial sum for each pair of groups and the ten
best terms of each group. Prices are integers, so their sums depend on no order.

Edge cases: null text, lang and source are ''; rows are documents, repeated
ones too; a group without terms, or a language without kept terms, has pairs
all the same; an empty table gives no rows; only the three columns are read;
a text of any length is counted whole, in one piece. The result has one row
for each ordered pair of a language's sources, as the audit asks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyhealth.llm.common import ASCII_LOWER, blobs, runs, small, staged

#: Documents of a language that must hold a term.
MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
#: Counts of a language in a bucket, about.
BUCKET_ROWS = 1 << 16
#: Parts of a language in the join with its totals.
SALTS = 256
#: Distinct terms that a worker holds before it sends them on.
HELD_TERMS = 200_000
#: Leaves of the pairs that are walked at a time, at most.
WALKED = 1 << 20
_LETTERS = bytes(b if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)).translate(ASCII_LOWER)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


# --- counts ----------------------------------------------------------------

def _counted(found: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs, rows) in found.items():
        keys = [b"", *n]
        for i in range(0, len(keys), 1 << 16):
            part = keys[i:i + (1 << 16)]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(part), pa.string()), "source": pa.array([source] * len(part), pa.string()),
                "term": pa.array(part, pa.binary()).cast(pa.string()),
                "n": pa.array([n[k] for k in part], pa.int64()), "docs": pa.array([docs[k] if k else rows for k in part], pa.int64())})


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term, by lang and source. The empty
    term stands for the group itself."""
    found: dict = {}
    held = 0
    for batch in small(batches):
        data, offsets = blobs(batch["text"])
        raw = data.tobytes()
        for i, group in enumerate(zip(batch["lang"].to_pylist(), batch["source"].to_pylist())):
            own = found.setdefault(group, [Counter(), Counter(), 0])
            before = len(own[0])
            words = terms(raw[offsets[i]:offsets[i + 1]])
            own[0].update(words)
            own[1].update(set(words))
            own[2] += 1
            held += len(own[0]) - before
        if held > HELD_TERMS:
            yield from _counted(found)
            found, held = {}, 0
    yield from _counted(found)


# --- the trees -------------------------------------------------------------

class Forest:
    """Segment trees of some groups over the term ids from 0 to ``size``. Nodes
    are numbered by level; node 0 of a level is the empty one."""

    def __init__(self, groups: int, size: int, group: np.ndarray, term: np.ndarray, count: np.ndarray):
        order = np.lexsort((term, group))
        group, at, count = group[order], term[order], count[order]
        self.counts, node = np.unique(np.r_[0, count], return_inverse=True)
        node = node[1:]
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        self.height = max(0, int(size - 1).bit_length())
        for _ in range(self.height):
            parent = group * (1 << 40) + (at >> 1)
            first = runs(parent)
            of = np.cumsum(np.r_[False, parent[1:] != parent[:-1]]) if len(parent) else parent
            sides = []
            for side in (0, 1):
                half = np.zeros(len(first), np.int64)
                mine = (at & 1) == side
                half[of[mine]] = node[mine]
                sides.append(half)
            base = int(node.max(initial=0)) + 1
            same, node = np.unique(np.r_[0, sides[0] * base + sides[1]], return_inverse=True)
            node = node[1:]
            self.children.append((same // base, same % base))
            group, at = group[first], at[first] >> 1
        self.root = np.zeros(groups, np.int64)
        self.root[group] = node

    def walk(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct leaf pairs of the trees a[i] and b[i], for all i: i, both
        leaves' numbers, and how often the pair occurs."""
        pair, x, y = np.arange(len(a)), self.root[a], self.root[b]
        times = np.ones(len(a), np.int64)
        for left, right in reversed(self.children):
            x, y = np.r_[left[x], right[x]], np.r_[left[y], right[y]]
            pair, times = np.r_[pair, pair], np.r_[times, times]
            order = np.lexsort((y, x, pair))
            pair, x, y, times = pair[order], x[order], y[order], times[order]
            first = np.flatnonzero(np.r_[True, (np.diff(pair) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0)])
            times = np.add.reduceat(times, first)
            pair, x, y = pair[first], x[first], y[first]
        return pair, x, y, times


def shares(forest: Forest, group: np.ndarray, leaf: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """p of each (group, leaf); ``totals`` is N + 2 V of each group. In Python's
    integers, as a count of a large corpus times the scale leaves 64 bits."""
    key, back = np.unique(group * len(forest.counts) + leaf, return_inverse=True)
    count = forest.counts[key % len(forest.counts)].astype(object)
    return (1 + SCALE * (count + 2) // totals[key // len(forest.counts)].astype(object)).astype(np.int64)[back]


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def price_pairs(forest: Forest, size: int, totals: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sum of the prices over the term ids of every two groups: first, second
    and value, for some pairs at a time."""
    groups = len(totals)
    room = max(1, WALKED >> forest.height)
    zero = np.zeros(groups, np.int64)
    none = shares(forest, np.arange(groups), zero, totals)
    for first in range(groups):
        for start in range(first + 1, groups, room):
            b = np.arange(start, min(start + room, groups))
            a = np.full(len(b), first)
            pair, x, y, times = forest.walk(a, b)
            value = price(shares(forest, a[pair], x, totals), shares(forest, b[pair], y, totals)) * times
            value = np.add.reduceat(value, runs(pair))
            # The ids beyond the last term are empty leaves and no terms.
            yield a, b, value - ((1 << forest.height) - size) * price(none[a], none[b])


def price_bucket(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Partial sums of the pairs and the best terms of a bucket. The rows with
    an empty term are the language's groups, with their N and its V."""
    lang, term = table["lang"][0].as_py(), table["term"].cast(pa.binary()).to_pylist()
    source = table["source"].cast(pa.binary()).to_pylist()
    n = table["n"].to_numpy()
    is_group = np.array([not t for t in term], bool)
    names = sorted({s for s, g in zip(source, is_group) if g})
    number = {s: i for i, s in enumerate(names)}
    group = np.array([number[s] for s in source], np.int64)
    totals = np.zeros(len(names) + 1, np.int64)
    totals[group[is_group]] = n[is_group]
    v = int(table["v"][int(np.flatnonzero(is_group)[0])].as_py())
    totals[-1] = totals.sum()
    totals += 2 * v

    group, n = group[~is_group], n[~is_group]
    words, at = np.unique(np.array([t for t in term if t] or [b""], object), return_inverse=True)
    if not len(n):
        words, at = words[:0], at[:0]
    whole = np.zeros(len(words), np.int64)
    np.add.at(whole, at, n)
    rank = np.empty(len(words), np.int64)
    rank[np.lexsort((np.arange(len(words)), -whole))] = np.arange(len(words))
    # The language itself is the last tree.
    forest = Forest(len(names) + 1, len(words), np.r_[group, np.full(len(words), len(names))],
                    np.r_[rank[at], rank], np.r_[n, whole])

    def rows(part: str, of: np.ndarray, item: list, value: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "lang": pa.array([lang] * len(of), pa.string()), "source": pa.array([names[i] for i in of], pa.binary()).cast(pa.string()),
            "part": pa.array([part] * len(of), pa.string()), "item": pa.array(item, pa.binary()).cast(pa.string()), "value": pa.array(value)})

    if len(words):
        for a, b, value in price_pairs(forest, len(words), totals[:-1]):
            yield rows("pair", a, [names[i] for i in b], value)
    else:
        for a in range(len(names) - 1):
            b = np.arange(a + 1, len(names))
            yield rows("pair", np.full(len(b), a), [names[i] for i in b], np.zeros(len(b), np.int64))
    if len(n):
        # A term's leaf in the group's tree against its leaf in the language's.
        p = shares(forest, group, np.searchsorted(forest.counts, n), totals)
        q = shares(forest, np.full(len(n), len(names)), np.searchsorted(forest.counts, whole[at]), totals)
        over = np.flatnonzero(p > q)
        value = price(p[over], q[over])
        order = np.lexsort((at[over], -value, group[over]))
        over, value = over[order], value[order]
        first = runs(group[over])
        place = np.arange(len(over)) - np.repeat(first, np.diff(np.r_[first, len(over)]))
        best = place < TOP
        yield rows("term", group[over[best]], list(words[at[over[best]]]), value[best])


def _price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from price_bucket(pa.Table.from_batches(list(batches)))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """lang, source, part, item, value and rank: the price of every group
    against each other source of its language, and its dearest terms against
    the language."""
    c = F.col
    texts = docs.select(*[F.coalesce(c(x), F.lit("")).alias(x) for x in ("text", "lang", "source")])
    counted = texts.mapInArrow(count_terms, "lang string, source string, term string, n long, docs long")
    # One exchange: a term's rows of a language lie together for all of this.
    same = W.partitionBy("lang", "term")
    counted = counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = counted.select("lang", "source", "term", "n", F.sum("docs").over(same).alias("all"),
                          (F.min("source").over(same) == c("source")).alias("first"))
    is_term = c("term") != ""
    kept = staged(kept.where(~is_term | (c("all") >= min_docs)).drop("all"), "terms")
    langs = kept.groupBy("lang").agg(F.count_if(is_term & c("first")).alias("v"),
                                     F.greatest(F.lit(1), F.ceil(F.count_if(is_term) / bucket_rows)).cast("int").alias("buckets"))
    # A language may hold most rows, so it is joined in SALTS parts by term, and its buckets are dealt anew.
    salted = langs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = kept.where(is_term).withColumn("salt", F.pmod(F.xxhash64("term", F.lit(1)), F.lit(SALTS)).cast("int")).join(
        salted, ["lang", "salt"]).select(
        "lang", F.pmod(F.xxhash64("term"), c("buckets")).cast("int").alias("bucket"), "source", "term", "n", "v")
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("n")).join(langs, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0), c("buckets") - 1)).alias("bucket"), "source", F.lit("").alias("term"), "n", "v")
    priced = dealt.unionByName(groups).repartition("lang", "bucket").groupBy("lang", "bucket").applyInArrow(
        _price, "lang string, source string, part string, item string, value long")
    priced = priced.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    turned = F.when(c("part") == "pair", F.array(F.struct("source", "item"), F.struct(c("item").alias("source"), c("source").alias("item")))
                    ).otherwise(F.array(F.struct("source", "item")))
    priced = priced.select("lang", "part", "value", F.inline(turned))
    best = W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return priced.withColumn("rank", F.row_number().over(best)).where((c("part") == "pair") | (c("rank") <= TOP)).select(
        "lang", "source", "part", "item", "value", "rank")


SQL = rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
df AS (SELECT lang, term, count(*) AS docs FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY 1, 2),
k AS (SELECT lang, term FROM df WHERE docs >= {MIN_DOCS}),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d)
      SEMI JOIN k USING (lang, term) GROUP BY 1, 2, 3),
gt AS (SELECT lang, source, coalesce(sum(n), 0) AS t FROM g LEFT JOIN c USING (lang, source) GROUP BY 1, 2),
gp AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
         CAST(1 + (CAST({SCALE} AS HUGEINT) * (coalesce(n, 0) + 2)) // (t + 2 * v) AS BIGINT) AS p
  FROM g JOIN k USING (lang) JOIN v USING (lang) JOIN gt USING (lang, source) LEFT JOIN c USING (lang, source, term)),
lp AS (
  SELECT lang, term, CAST(1 + (CAST({SCALE} AS HUGEINT) * (sum(n) + 2)) // (any_value(lt) + 2 * any_value(v)) AS BIGINT) AS q
  FROM gp JOIN v USING (lang) JOIN (SELECT lang, sum(t) AS lt FROM gt GROUP BY 1) USING (lang) GROUP BY 1, 2),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gp x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN gp y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY 1, 2, 3),
terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM gp JOIN lp USING (lang, term) WHERE n > 0 AND p > q),
a AS (
  SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value FROM pairs
  UNION ALL SELECT lang, source, 'term', item, CAST(value AS BIGINT) FROM terms),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM a)
SELECT * FROM r WHERE part = 'pair' OR rank <= {TOP}
"""
