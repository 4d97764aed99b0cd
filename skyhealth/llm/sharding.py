"""Sharding by sampled splitters.

Records are ordered by (hash of the text, doc_id). Keys drawn with probability
in proportion to record size give quantile boundaries; records are ranged by
them, ranges that turn out overfull are subdivided by a denser draw of their
own, and exact prefix sums over the ranges then place every record, so the
shards do not depend on the draw. The law held is ``bytes``.

Equal texts have equal hashes, so a group of copies stays in one shard. Only a
group larger than 1/20 of a shard (there are at most 20 per shard of them) is
subdivided, by doc_id, and its records say so (``group_split``); so shards differ by at most about 1/20 of the mean plus
one record.

Edge cases: a null text has size 1 and checksum 0 and groups with the empty
text; null doc_ids sort first; repeated rows are placed one by one; a very
long text is one record, and no shard can hold less than it; an empty
table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyhealth.llm.common import staged

SHARDS = 16
#: Ranges aimed at; a range over twice the mean is subdivided.
RANGES = 1024
DRAWS_PER_RANGE = 16
WHOLE_GROUP = 20
LOWEST = -(1 << 63)


def records(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long").alias("h"),
        F.coalesce(F.col("doc_id"), F.lit(LOWEST)).alias("id"))


def draw(rows: DataFrame, rate: float) -> pd.DataFrame:
    """Keys drawn with probability size * rate, the same keys at every run.
    A record of several ranges' size is drawn for sure."""
    coin = F.pmod(F.xxhash64("h", "id", F.lit(7)), F.lit(1 << 40)) / float(1 << 40)
    return rows.where(coin < F.col("size") * rate).select("h", "id").toPandas()


def range_of(bounds: pd.DataFrame):
    """Number of boundaries at or below a key; boundaries are broadcast."""
    hs, ids = bounds["h"].to_numpy(np.int64), bounds["id"].to_numpy(np.int64)

    @F.pandas_udf("int")
    def number(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for h, i in batches:
            h, i = h.to_numpy(np.int64), i.to_numpy(np.int64)
            low, high = np.searchsorted(hs, h, "left"), np.searchsorted(hs, h, "right")
            for k in np.unique(low[low < high]):
                mine = (low == k) & (low < high)
                top = high[mine][0]
                low[mine] = k + np.searchsorted(ids[k:top], i[mine], "right")
            yield pd.Series(low.astype(np.int32))

    return number("h", "id")


def quantiles(drawn: pd.DataFrame, parts: int, hot: set[int]) -> pd.DataFrame:
    """``parts - 1`` keys that cut the draw evenly. A boundary inside a group
    that is to stay whole moves to the group's start."""
    drawn = drawn.sort_values(["h", "id"], ignore_index=True)
    at = (np.arange(1, parts) * len(drawn)) // max(1, parts)
    cut = drawn.iloc[at[at < len(drawn)]].copy()
    cut.loc[~cut["h"].isin(hot), "id"] = LOWEST
    return cut.drop_duplicates()


def shard(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null) and
    group_split: whether the equal texts of the record are too many to stay
    together under the law, so that doc_id divides them."""
    # Sizes and hashes only; the passes below never read a text again.
    rows = staged(records(docs), "records")
    totals = rows.agg(F.sum("size").alias("b"), F.count("*").alias("n")).first()
    total, n = totals.b or 0, totals.n
    out = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "group_split")
    if not n:
        return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                           F.lit(False).alias("group_split"))
    # At most shards * WHOLE_GROUP groups can be that large.
    hot = {r.h for r in rows.groupBy("h").agg(F.sum("size").alias("b"))
           .where(F.col("b") * (shards * WHOLE_GROUP) > total).select("h").collect()}
    bounds = quantiles(draw(rows, ranges * DRAWS_PER_RANGE / total), ranges, hot)
    for _ in range(3):
        bounds = bounds.sort_values(["h", "id"], ignore_index=True)
        sizes = rows.groupBy(range_of(bounds).alias("r")).agg(F.sum("size").alias("b"), F.count("*").alias("n")).toPandas()
        over = sizes[sizes["b"] > 2 * total / ranges]
        if not len(over):
            break
        ranged = rows.withColumn("r", range_of(bounds)).where(F.col("r").isin([int(r) for r in over["r"]]))
        denser = [(int(r), int(np.ceil(b * ranges / total)) + 1) for r, b in zip(over["r"], over["b"])]
        drawn = draw(ranged, 4 * ranges * DRAWS_PER_RANGE / total)
        edge = np.searchsorted(_ordinal(bounds), _ordinal(drawn), "right") if len(drawn) else np.zeros(0, int)
        more = [quantiles(drawn[edge == r], parts, hot) for r, parts in denser]
        grown = pd.concat([bounds, *more]).drop_duplicates()
        if len(grown) == len(bounds):
            break
        bounds = grown
    bounds = bounds.sort_values(["h", "id"], ignore_index=True)
    spark = docs.sparkSession
    sizes = rows.groupBy(range_of(bounds).alias("r")).agg(F.sum("size").alias("b"), F.count("*").alias("n")).toPandas().sort_values("r")
    offsets = spark.createDataFrame(pd.DataFrame({
        "r": sizes["r"].astype("int32"), "b0": sizes["b"].cumsum() - sizes["b"], "n0": sizes["n"].cumsum() - sizes["n"]}),
        "r int, b0 long, n0 long")
    own = W.partitionBy("r").orderBy("h", "id", "size", "text_crc32")
    group = W.partitionBy("r", "h").orderBy("id", "size", "text_crc32").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = (rows.withColumn("r", range_of(bounds)).join(F.broadcast(offsets), "r")
              .withColumn("before", F.col("b0") + F.sum("size").over(own.rowsBetween(W.unboundedPreceding, 0)) - F.col("size"))
              .withColumn("place", F.col("n0") + F.row_number().over(own) - 1))
    split = F.col("h").isin(sorted(hot)) if hot else F.lit(False)
    start = F.when(split, F.col("before")).otherwise(F.min("before").over(group))
    placed = placed.withColumn("shard", F.floor(start * shards / F.lit(total)).cast("int"))
    first = placed.groupBy("shard").agg(F.min("place").alias("p0"))
    return (placed.join(F.broadcast(first), "shard")
            .withColumn("law", F.lit("bytes")).withColumn("slot", F.col("place") - F.col("p0"))
            .withColumn("grown_shard", F.lit(None).cast("int")).withColumn("group_split", split).select(*out))


def _ordinal(keys: pd.DataFrame) -> np.ndarray:
    """Sortable pairs (h, id) as one structured array."""
    pair = np.empty(len(keys), [("h", np.int64), ("id", np.int64)])
    pair["h"], pair["id"] = keys["h"].to_numpy(), keys["id"].to_numpy()
    return pair


SQL = r"""
WITH tbl AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n, range(0, 8)),
             lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(0, 256)) AS n))),
r AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, substr(md5(coalesce(text, '')), 1, 15) AS h,
         hex(encode(coalesce(text, ''))) AS x FROM documents),
crc AS (
  SELECT x, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
           list_transform(range(0, len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1]))) AS text_crc32
  FROM (SELECT DISTINCT x FROM r), tbl),
o AS (
  SELECT doc_id, size, h, text_crc32,
         CAST(sum(size) OVER (ORDER BY h, doc_id, size, text_crc32 ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS before,
         row_number() OVER (ORDER BY h, doc_id, size, text_crc32) AS place,
         sum(size) OVER (PARTITION BY h) AS group_size, sum(size) OVER () AS total
  FROM r JOIN crc USING (x)),
s AS (
  SELECT *, CAST(floor(CASE WHEN group_size * 320 > total THEN before ELSE min(before) OVER (PARTITION BY h) END
                       * 16 / total) AS INTEGER) AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard,
       group_size * 320 > total AS group_split
FROM s
"""
