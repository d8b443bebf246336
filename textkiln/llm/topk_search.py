"""Exact top-k inner product search (operator 9).

Vectors become integer components ``floor(scale * x)``; rows are range
partitioned by descending length and sorted, so a task meets its longest vectors
first.  An orthogonal rotation from the corpus' Gram matrix (its SVD) moves most
of the length into the first dimensions.  For a block of queries, a task takes
chunks of vectors and keeps each query's k best so far; a vector is given up
where |q| |x| (then the whole rest of the partition, as it is sorted), or the
partial sum over the leading rotated dimensions plus the product of the
residual lengths, cannot reach the k-th score.  What remains is scored
exactly in 64-bit integers.  Tasks' results (k rows a query) meet in a partial
top-k before the shuffle.

Queries go out in blocks of ``block`` rows, a broadcast of that many rows at
most whatever their number, and each block is a pass over the sorted rows, whose
results are written before the next block is read.

Edge cases: a vector that is null, or has a null, NaN or infinite component,
takes no part; shorter vectors count as padded with zeros, an empty one is the
zero vector; ties go to the smaller id; a row is not its own neighbour, by id;
null ids take no part; repeated candidates count each; fewer candidates than k
give all; no queries or an empty table give no rows; only id and vector are read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.llm.common import written

K = 5
SCALE = 256
BLOCK = 4096  # queries in one broadcast
LEADING = 16  # rotated dimensions of the partial sums

_FOUND = T.StructType([
    T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of an Arrow list column, padded with zeros to ``dims``."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    if len(flat) == len(lengths) * dims and (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), flat.dtype)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def _gram(dims: int):
    def gram(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column(1), dims).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "row"])

    return gram


def _search(ids: np.ndarray, queries: np.ndarray, rotation: np.ndarray, k: int, leading: int):
    dims = queries.shape[1]

    def search(batches):
        rotated = queries @ rotation
        head, rest = rotated[:, :leading], np.sqrt(np.square(rotated[:, leading:]).sum(1))
        length = np.sqrt(np.square(queries.astype(float)).sum(1))
        slack = 1e-9 * length  # floating point only bounds; scores are exact
        best = np.full((len(ids), k), np.iinfo(np.int64).min)
        owner = np.full((len(ids), k), np.iinfo(np.int64).max)
        worst = np.full(len(ids), -np.inf)
        step = max(64, (2 << 20) // max(1, len(ids)))
        for batch in batches:
            vec_ids, whole = batch.column(0).to_numpy(), _matrix(batch.column(1), dims)
            for at in range(0, len(whole), step):
                x, own = whole[at : at + step].astype(np.int64), vec_ids[at : at + step]
                norm = np.sqrt(np.square(x.astype(float)).sum(1))
                live = np.flatnonzero(length * norm.max() + (slack + 1e-9) * norm.max() >= worst)
                if not len(live):
                    continue  # sorted: nothing longer follows in this partition
                r = x @ rotation
                bound = head[live] @ r[:, :leading].T + np.outer(rest[live], np.sqrt(np.square(r[:, leading:]).sum(1)))
                bound += np.outer(slack[live], norm) + 1e-6
                qi, xi = np.nonzero(bound >= worst[live][:, None])
                qi = live[qi]
                keep = ids[qi] != own[xi]
                qi, xi = qi[keep], xi[keep]
                if not len(qi):
                    continue
                score = np.concatenate([np.einsum("ij,ij->i", queries[qi[a : a + 65536]], x[xi[a : a + 65536]]) for a in range(0, len(qi), 65536)])
                # The held rows and the new ones, by query, score and id; the first k of each query stay.
                touched = np.unique(qi)
                q = np.concatenate([np.repeat(touched, k), qi])
                s = np.concatenate([best[touched].ravel(), score])
                v = np.concatenate([owner[touched].ravel(), own[xi]])
                order = np.lexsort((v, -s.astype(np.float64), q)) if np.abs(score).max() < 1 << 52 else np.array(sorted(range(len(q)), key=lambda i: (q[i], -int(s[i]), v[i])))
                q, s, v = q[order], s[order], v[order]
                start = np.searchsorted(q, touched)
                take = start[:, None] + np.arange(k)
                best[touched], owner[touched] = s[take], v[take]
                worst[touched] = np.where(owner[touched][:, -1] == np.iinfo(np.int64).max, -np.inf, best[touched][:, -1].astype(float))
        have = owner.ravel() != np.iinfo(np.int64).max
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(ids, k)[have]), pa.array(owner.ravel()[have]), pa.array(best.ravel()[have])], names=["query_id", "vec_id", "score"])

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding",
          block: int = BLOCK, leading: int = LEADING) -> DataFrame:
    """For each row where ``is_query`` (over the column ``vec_id``) holds, the
    ``k`` other rows of the highest integer inner product: ``query_id, rank,
    vec_id, score``."""
    x = F.transform(vector, lambda c: c.cast("double"))
    sound = F.col(vector).isNotNull() & F.col(vec_id).isNotNull() & ~F.exists(
        x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.filter(sound).select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale)).alias("x"))
    rows = rows.withColumn("norm", F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c))
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Ids spread equal lengths over partitions' bounds, so that many copies of one vector are many tasks.
    rows = written(rows.repartitionByRange(parts, F.desc("norm"), "vec_id").sortWithinPartitions(F.desc("norm"), "vec_id"), "vectors-by-length")
    queries = rows.filter(is_query)
    n, dims = queries.count(), rows.agg(F.max(F.size("x"))).first()[0]
    spark = vectors.sparkSession
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = max(dims, 1)
    narrow = rows.select("vec_id", "x")
    sums = narrow.mapInArrow(_gram(dims), "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    gram = np.zeros((dims, dims))
    for r in sums.collect():  # dims * dims numbers
        gram[r["i"], r["j"]] = r["v"]
    rotation = np.linalg.svd(gram)[0]
    blocks, found = -(-n // block), []
    for b in range(blocks):
        held = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).select("vec_id", "x").toArrow()
        if held.num_rows:
            q = _matrix(held.column(1).combine_chunks(), dims).astype(np.int64)
            best = narrow.mapInArrow(_search(held.column(0).to_numpy(), q, rotation, k, min(leading, dims)), _FOUND)
            # Several blocks: each one's rows are written before the next one is read, so that the driver holds one.
            found.append(best if blocks == 1 else written(best, f"topk-{b}"))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
