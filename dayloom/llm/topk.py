"""Exact top-k inner products from an impact-ordered index, score at a time.

Vectors are dealt to blocks. Within a block each component's values are cut into levels, and
the vectors of one (component, level) form a posting segment. For a query a segment's impact
is the most that it can add over the least of its component. Segments are processed by
descending impact; what is known of a vector bounds its score from below and above. Processing
stops only when the upper bounds prove that all but a few vectors are out, or at the end; the
vectors that remain possible are scored exactly. Blocks of vectors meet blocks of queries, and
the k best of each block are merged.

Defined results: a vector that is null or holds a null or non-finite component takes no part,
nor does a row without an id; missing trailing components count as 0; every row of an id that
repeats is a candidate and a query, and a query's candidates are the rows of all other ids
(with ``one_each`` an id counts once, with the smallest of its vectors); a query with fewer candidates than k gets all
of them; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
#: Vectors and queries of a block, about.
VECTORS, QUERIES = 4096, 512
#: Levels of a component's values, and segments between two proofs.
LEVELS, BETWEEN = 4, 32
RESULT = "query_id long, vec_id long, score long"


def integer_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE,
                    one_each: bool = True) -> DataFrame:
    """vec_id and ``v``, the components times ``scale``, rounded down; only rows that take part.

    Without ``one_each`` all rows of an id stay, with a number ``row`` by which they are dealt;
    write the frame before it is used, since a second run may number the rows otherwise.
    """
    value = F.col(embedding).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(value, lambda x: F.floor(x * float(scale)).cast("long"))
    taking = rows.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull()).where(finite)
    found = taking.select(F.col(vec_id).cast("long").alias("vec_id"), scaled.alias("v"))
    if one_each:
        return found.groupBy("vec_id").agg(F.min("v").alias("v"))
    return found.withColumn("row", F.monotonically_increasing_id())


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


class ImpactIndex:
    """Posting segments of a block of vectors."""

    def __init__(self, x: np.ndarray):
        self.x = x
        rows, low, high, dim = [], [], [], []
        for d in range(x.shape[1]):
            order = np.argsort(x[:, d], kind="stable")
            for part in np.array_split(order, LEVELS):
                if len(part):
                    rows.append(part)
                    low.append(x[part[0], d])
                    high.append(x[part[-1], d])
                    dim.append(d)
        self.rows, self.dim = rows, np.array(dim, np.int64)
        self.low, self.high = np.array(low, np.int64), np.array(high, np.int64)

    def possible(self, q: np.ndarray, k: int, out: np.ndarray) -> np.ndarray:
        """Rows that may be among the k best for ``q``; ``out`` are rows that take no part."""
        n, width = self.x.shape
        if n - len(out) <= k or not width:
            return np.setdiff1d(np.arange(n), out)
        a, b = q[self.dim] * self.low, q[self.dim] * self.high
        most, least = np.maximum(a, b), np.minimum(a, b)
        base = np.full(width, np.iinfo(np.int64).max)
        np.minimum.at(base, self.dim, least)
        up, down = most - base[self.dim], least - base[self.dim]
        order = np.argsort(-up, kind="stable")
        # Scores over the sum of the least of each component: known part from below and above.
        below, above, open_ = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, width, np.int64)
        below[out] = np.iinfo(np.int64).min // 2
        left = np.setdiff1d(np.arange(n), out)
        for at in range(0, len(order), BETWEEN):
            for s in order[at : at + BETWEEN]:
                rows = self.rows[s]
                below[rows] += down[s]
                above[rows] += up[s]
                open_[rows] -= 1
            nxt = up[order[at + BETWEEN]] if at + BETWEEN < len(order) else 0
            kth = np.partition(below, n - k)[n - k]
            left = left[above[left] + open_[left] * nxt >= kth]
            if len(left) <= 4 * k:
                break
        return left


def search_block(vectors: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of one block of vectors for each query of a block."""
    if not len(vectors) or not len(queries):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    width = int(max(vectors["v"].map(len).max(), queries["v"].map(len).max()))
    ids = vectors["vec_id"].to_numpy(np.int64)
    x, q = matrix(vectors["v"], width), matrix(queries["v"], width)
    index, found = ImpactIndex(x), []
    for query_id, v in zip(queries["vec_id"].to_numpy(np.int64), q):
        rows = index.possible(v, k, np.flatnonzero(ids == query_id))
        scores = x[rows] @ v
        best = np.lexsort((ids[rows], -scores))[:k]
        found.append((np.full(len(best), query_id), ids[rows][best], scores[best]))
    return pd.DataFrame({c: np.concatenate(v).astype(np.int64) for c, v in zip(("query_id", "vec_id", "score"), zip(*found))})


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id and score; ties go to the smaller id.

    Both frames come from ``integer_vectors``. A task holds one block of each; a vector is
    copied once for each block of queries and the other way round.
    """
    n, n_queries = vectors.count(), queries.count()
    v_blocks, q_blocks = max(1, -(-n // VECTORS)), max(1, -(-n_queries // QUERIES))

    def dealt(rows: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64(*(c for c in rows.columns if c != "v")), F.lit(blocks)).cast("int").alias(own)
        return rows.select("vec_id", "v", block, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    a = dealt(vectors, "_vb", v_blocks, "_qb", q_blocks).groupBy("_vb", "_qb")
    b = dealt(queries, "_qb", q_blocks, "_vb", v_blocks).groupBy("_vb", "_qb")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return search_block(left, right, k)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = a.cogroup(b).applyInPandas(search, RESULT)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
