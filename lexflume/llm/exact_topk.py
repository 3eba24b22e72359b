"""Exact top-k inner products over an impact-ordered index, a score at a time.

Vectors become integers, floor(256 x). Candidates are cut into blocks. A block's index writes each value, less the least
value of its dimension, as binary digits, and holds for each power of two the postings (dimension, row) that have it: a
posting segment of impact 2^b. A block of queries processes segments by descending impact, all dimensions of an impact
together, so that each round adds a bit-matrix product to the accumulators. What is unprocessed then lies between 0 and
2^b - 1 in every dimension, which bounds every row's score from both sides. A query stops only when those bounds prove
that no row outside a short list is among its best k; the list is rescored exactly with integers. A block's index is
built once, in one task, and all queries stream past it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexflume.llm.common import table

K, EVERY = 5, 50
#: Rows of a candidate block, about; queries that are searched at once; the lists that are short enough to rescore.
BLOCK, QUERIES, SHORT = 8192, 256, 200


class Index:
    """Segments of one block: for each power of two, from the greatest, the rows and dimensions that have it."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.base = x.min(axis=0)
        above = x - self.base
        self.bits = int(above.max()).bit_length() if above.size else 0
        self.segments = [(b, ((above >> b) & 1).astype(np.uint8)) for b in range(self.bits - 1, -1, -1)]

    def search(self, q: np.ndarray, own: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """For each query (a row of q, its own id in own) the (row, score) of its k best other rows.

        Ordered by score descending, id ascending. Accumulators are doubles; where sums could pass 2^52 the bounds are
        widened by their rounding, and scores themselves are always summed as integers.
        """
        n, out = len(self.ids), [[] for _ in own]
        best, active = min(n, k + 1), np.arange(len(q))  # one of the best may be the query itself
        up, down = np.maximum(q, 0).sum(axis=1), np.minimum(q, 0).sum(axis=1)
        sums = np.repeat((q @ self.base).astype(float)[:, None], n, axis=1)
        size = np.abs(q).astype(float).sum(axis=1) * float(np.abs(self.x).max(initial=1) + (1 << self.bits))
        unsure = np.where(size < 2.0**52, 0.0, size * 2.0**-44)
        for b, segment in [*self.segments, (0, None)]:
            if segment is not None:
                sums += (q[active].astype(float) * float(1 << b)) @ segment.T.astype(float)
                if 2 * (self.bits - b) < self.bits and n > SHORT:
                    continue  # too few digits to prove anything
            rest = float((1 << b) - 1)
            low, high = rest * down[active] - unsure[active], rest * up[active] + unsure[active]
            theta = np.partition(sums, n - best, axis=1)[:, n - best] + low
            may = sums + high[:, None] >= theta[:, None]
            done = (may.sum(axis=1) <= SHORT) | (segment is None)
            for i in np.flatnonzero(done):
                rows = np.flatnonzero(may[i])
                rows = rows[self.ids[rows] != own[active[i]]]
                exact = self.x[rows] @ q[active[i]]
                top = np.lexsort((self.ids[rows], -exact))[:k]
                out[active[i]] = [(int(self.ids[rows[t]]), int(exact[t])) for t in top]
            active, sums = active[~done], sums[~done]
            if not len(active):
                break
        return out


def _search(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows sorted by block and length, a block's candidates before the queries: the best k of each query in each block."""
        key, held, index = None, [], None
        for batch in batches:
            ids, vectors, b, dims, asks, q = (batch[c].to_numpy() for c in ("vec_id", "v", "b", "dims", "asks", "q"))
            cut = np.flatnonzero((b[1:] != b[:-1]) | (dims[1:] != dims[:-1]) | (asks[1:] != asks[:-1])) + 1
            for rows in np.split(np.arange(len(batch)), cut):
                if not len(rows):
                    continue
                if key != (b[rows[0]], dims[rows[0]]):
                    key, held, index = (b[rows[0]], dims[rows[0]]), [], None
                x = np.stack(vectors[rows]).astype(np.int64)
                if not asks[rows[0]]:
                    held.append((ids[rows], x))
                    continue
                if not held:  # no candidates of this length here
                    continue
                if index is None:
                    own, all_ = (np.concatenate(c) for c in zip(*held, strict=True))
                    order = np.argsort(own, kind="stable")
                    index = Index(own[order], all_[order])
                out = []
                for at in range(0, len(rows), QUERIES):
                    some = slice(at, at + QUERIES)
                    for i, h, found in zip(ids[rows][some], q[rows][some], index.search(x[some], ids[rows][some], k), strict=True):
                        out += [(i, h, j, s) for j, s in found]
                yield pd.DataFrame(out, columns=["query_id", "q", "vec_id", "score"], dtype="int64")

    return run


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<long>, dims) of the vectors whose components are all finite; the others take no part."""
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("e")).where("vec_id is not null and e is not null")
    fine = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.where(fine).select("vec_id", F.transform("e", lambda x: F.floor(x * 256).cast("long")).alias("v"), F.size("e").alias("dims"))


def exact_topk(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for each row whose id is divisible by `every`.

    Ties go to the smaller id. Vectors meet only those of their own length. A row that is repeated is asked once, and as
    a candidate it counts each time; rows with one id and unlike vectors are queries of their own under that id, and
    never each other's candidates. Null vectors, and those with null or non-finite components, take no part; an empty
    table gives an empty result.
    """
    v = integers(vectors)
    blocks = max(1, -(-v.count() // BLOCK))
    # dealt by row, not by id alone: repeats of an id are in different blocks too
    rows = v.withColumns({"b": F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"), "asks": F.lit(False), "q": F.lit(0).cast("long")})
    queries = v.where(F.col("vec_id") % every == 0).withColumn("q", F.xxhash64("v")).dropDuplicates(["vec_id", "q", "v"])
    queries = queries.withColumns({"b": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), "asks": F.lit(True)})
    dealt = rows.unionByName(queries).repartition("b").sortWithinPartitions("b", "dims", "asks")
    found = dealt.mapInPandas(_search(k), "query_id long, q long, vec_id long, score long")
    best = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(table(spark, sf_dir, "embeddings"))


OP2_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, q.e qe, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::bigint score
  from (select distinct vec_id, e from v) q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(q.e) = len(c.e)),
r as (select *, row_number() over (partition by query_id, qe order by score desc, vec_id) n from s)
select query_id, n::int as rank, vec_id, score from r where n <= 5
"""
