"""Exact top-k inner products by KD-trees, one per shard of the vectors.

Vectors are cut into shards of bounded size. Each shard gets a KD-tree, built once: nodes are
split at the median of their widest coordinate and carry the tight box of their points, so a
node's greatest possible inner product with a query is the sum of the larger of q*low and
q*high over the coordinates. A query walks a tree best first and stops when no box left can
reach its k-th score.

Query blocks meet shards by equi-join on (shard, block). First each block searches one shard;
the k-th scores found there go along to all other shards, where they prune from the start. What
the shards return, k rows a query, is ranked by a window per query.
"""

from __future__ import annotations

import heapq
import pickle

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridemart.llm.common import stored

K = 5
#: Vectors of a shard, queries of a block, points of a leaf.
SHARD_ROWS = 4_096
BLOCK_ROWS = 4_096
LEAF = 128
#: Sums of products below this are exact in double arithmetic.
EXACT = 2.0**53
#: Components are kept within 128 bits of the largest float; scores are held to the range of a long.
LONG = (-(2**63), 2**63 - 1)


def quantised(vector: str | Column) -> Column:
    """floor(256 * x) of each component as double; null for a vector that takes no part."""
    column = F.col(vector) if isinstance(vector, str) else vector
    wide = F.transform(column, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # floor() of a large double would not fit a long; such a value is whole already.
    floored = lambda x: F.when(F.abs(x) < F.lit(2.0**53), F.floor(x).cast("double")).otherwise(x)
    return F.when(column.isNotNull() & finite, F.transform(wide, lambda x: floored(x * 256)))


# ---- one tree --------------------------------------------------------------------------


def build(ids, nulls, points, leaf: int = LEAF) -> dict:
    """A KD-tree over points (n, d) with their ids; points end up in leaf order."""
    import numpy as np

    n = len(points)
    order = np.arange(n)
    low, high, spans, children, smallest = [], [], [], [], []
    key = np.where(nulls, np.iinfo(np.int64).max, ids)
    todo = [(0, n, -1)]
    while todo:
        start, end, parent = todo.pop()
        own, node = order[start:end], len(spans)
        if parent >= 0:
            children[parent].append(node)
        block = points[own]
        low.append(block.min(0))
        high.append(block.max(0))
        spans.append((start, end))
        children.append([])
        smallest.append(key[own].min())
        if end - start > leaf:
            width = high[-1] - low[-1]
            middle = (end - start) // 2
            # Equal points are cut by position, so no leaf exceeds its size.
            order[start:end] = own[np.argpartition(block[:, int(width.argmax())], middle)] if block.shape[1] else own
            todo += [(start + middle, end, node), (start, start + middle, node)]
    return {
        "ids": ids[order], "nulls": nulls[order], "points": points[order], "low": np.array(low), "high": np.array(high),
        "spans": spans, "children": children, "smallest": np.array(smallest, np.int64),
    }


def search(tree: dict, queries, k: int, floors) -> list[list[tuple[int, int, bool]]]:
    """For each query up to k (score, position, ...) of the tree's points, best first, ties to smaller ids.

    ``floors`` are scores that k other points are known to reach: points below are left out.
    """
    import numpy as np

    points, low, high = tree["points"], tree["low"], tree["high"]
    key = np.where(tree["nulls"], np.iinfo(np.int64).max, tree["ids"])
    most = float(np.abs(points).max(initial=0.0)) * float(np.abs(queries).max(initial=0.0)) * max(1, points.shape[1])
    if most >= EXACT:  # beyond exact doubles: Python's whole numbers
        whole = np.vectorize(int, otypes=[object])
        points, queries, low, high = (whole(x) if x.size else x.astype(object) for x in (points, queries, low, high))
    bounds = np.maximum(queries, 0).dot(high.T) + np.minimum(queries, 0).dot(low.T)
    children, spans, smallest = tree["children"], tree["spans"], tree["smallest"].tolist()
    out = []
    for query, bound, floor in zip(queries, bounds.tolist(), floors, strict=True):
        found: list[tuple] = []  # (-score, id, position), sorted, k at most
        frontier = [(-bound[0], smallest[0], 0)]
        while frontier:
            reach, least, node = heapq.heappop(frontier)
            if floor is not None and -reach < floor:
                break
            if len(found) == k and (reach, least) > found[-1][:2]:
                if -reach < -found[-1][0]:
                    break
                continue  # its points can at best tie, with greater ids
            if children[node]:
                for child in children[node]:
                    heapq.heappush(frontier, (-bound[child], smallest[child], child))
                continue
            start, end = spans[node]
            scores = points[start:end].dot(query)
            bar = floor
            if len(found) == k:
                bar = -found[-1][0] if bar is None else max(bar, -found[-1][0])
            kept = np.arange(end - start) if bar is None else np.nonzero(scores >= bar)[0]
            if len(kept) > k:  # the k best of the leaf do
                kept = kept[np.lexsort((key[start:end][kept], -scores[kept]))[:k]]
            if len(kept):
                found += [(-scores[i], int(key[start + i]), start + int(i)) for i in kept]
                found.sort()
                del found[k:]
        out.append([(int(-s), position) for s, _, position in found])
    return out


# ---- whole tables ----------------------------------------------------------------------


def _packed(vectors: DataFrame, rows: int, with_tree: bool, purpose: str) -> DataFrame:
    """The vectors in chunks of at most ``rows``, all of one length: chunk, dim, number, data."""
    import pyarrow as pa

    count = vectors.count()
    # Identical vectors have different ids, so a vector that many rows share is spread as well.
    dealt = vectors.repartition(max(1, -(-count // rows)), F.xxhash64("vec_id", "q"))
    shape = pa.schema([("chunk", pa.int64()), ("dim", pa.int32()), ("data", pa.binary())])

    def chunks(batches):
        import numpy as np
        from pyspark import TaskContext

        held: dict[int, list] = {}
        made = TaskContext.get().partitionId() << 32

        def close(dim):
            nonlocal made
            ids, points = zip(*held.pop(dim), strict=True)
            nulls = np.array([i is None for i in ids])
            ids = np.array([0 if i is None else i for i in ids], np.int64)
            points = np.array(points, np.float64).reshape(len(ids), dim)
            data = build(ids, nulls, points) if with_tree else {"ids": ids, "nulls": nulls, "points": points}
            batch = pa.RecordBatch.from_arrays(
                [pa.array([made], pa.int64()), pa.array([dim], pa.int32()), pa.array([pickle.dumps(data, 5)], pa.binary())], schema=shape
            )
            made += 1
            return batch

        for batch in batches:
            for vec_id, q in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = q.values.to_numpy(zero_copy_only=False)
                held.setdefault(len(values), []).append((vec_id, values))
                if len(held[len(values)]) == rows:
                    yield close(len(values))
        for dim in list(held):
            yield close(dim)

    made = stored(dealt.select("vec_id", "q").mapInArrow(chunks, "chunk long, dim int, data binary"), purpose)
    place = F.row_number().over(W.partitionBy("dim").orderBy("chunk")) - 1
    names = made.select("chunk", "dim").withColumn("number", place)  # a row a chunk, without its data
    return made.join(names, ["chunk", "dim"])


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """Searches the shard in ``data`` for the block in ``queries``, from the floors in ``floors``."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        out = []
        for row in rows.itertuples(index=False):
            tree, block = pickle.loads(row.data), pickle.loads(row.queries)
            n = len(block["ids"])
            known = [] if row.floors is None else [None if x == LONG[0] else int(x) for x in row.floors]
            floors = known + [None] * (n - len(known))
            for number, hits in enumerate(search(tree, block["points"], k + 1, floors)):
                query = int(block["ids"][number])
                for score, at in hits:
                    own = not tree["nulls"][at] and int(tree["ids"][at]) == query and np.array_equal(tree["points"][at], block["points"][number])
                    vec_id = None if tree["nulls"][at] else int(tree["ids"][at])
                    out.append((row.block, number, query, vec_id, min(max(score, LONG[0]), LONG[1]), own))
        names = ["block", "query_no", "query_id", "vec_id", "score", "own"]
        return pd.DataFrame(out, columns=names).astype({"vec_id": "Int64"})

    # Groups reach Python one at a time, so a task holds one shard and one block.
    shape = "block long, query_no int, query_id long, vec_id long, score long, own boolean"
    return pairs.groupBy("number", "block").applyInPandas(run, shape)


def top_k(
    vectors: DataFrame,
    queries: Column | str,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best other rows, or all if there are fewer.

    ``queries`` is the condition that makes a row a query. Only vectors of a query's own length
    are compared with it. Of rows that equal the query in id and vector one is taken for the
    query itself; repeated rows are candidates like any other, and repeated queries are answered
    separately. A null id can be found (ranked after all ids) but asks nothing. Vectors that are
    null or hold nulls, NaN or infinities take no part; an empty table gives an empty table.
    Scores beyond a long are held at its bounds, in any order. Other columns are not read.
    """
    rows = stored(
        vectors.select(F.col(key).cast("long").alias("vec_id"), quantised(vector).alias("q"), F.expr(queries).alias("_asks") if isinstance(queries, str) else queries.alias("_asks")),
        "quantised",
    ).filter("q IS NOT NULL")
    shards = _packed(rows, shard_rows, True, "kd_trees")
    blocks = _packed(rows.filter("_asks AND vec_id IS NOT NULL"), block_rows, False, "query_blocks").select(
        F.col("chunk").alias("block"), "dim", F.col("number").alias("block_no"), F.col("data").alias("queries")
    )
    # One row for each length of vectors, which is all that is broadcast below.
    many = shards.groupBy("dim").agg(F.count(F.lit(1)).alias("shards"))
    asked = blocks.groupBy("dim").agg(F.count(F.lit(1)).alias("blocks"))
    wanted = blocks.join(F.broadcast(many), "dim").withColumn("home", F.col("block_no") % F.col("shards"))

    home = wanted.withColumn("number", F.col("home")).join(shards.select("dim", "number", "data"), ["dim", "number"])
    first = stored(
        _searched(home.select("number", "block", "data", "queries", F.lit(None).cast("array<long>").alias("floors")), k), "first_hits"
    )
    # The (k+1)-th score, since one of the hits may be the query itself.
    floors = (
        first.groupBy("block", "query_no")
        .agg(F.when(F.count(F.lit(1)) > k, F.min("score")).alias("floor"))
        .groupBy("block")
        .agg(F.map_from_entries(F.collect_list(F.struct("query_no", "floor"))).alias("known"))  # one block's queries
    )
    rest = (
        wanted.join(floors, "block", "left")
        .withColumn("number", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        .filter("number <> home")
    )
    spread = (
        shards.join(F.broadcast(asked), "dim")
        .withColumn("block_no", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("dim", "number", "block_no", "data")
    )
    pairs = rest.join(spread, ["dim", "number", "block_no"])
    further = _searched(pairs.select("number", "block", "data", "queries", _floor_list()), k)

    each = W.partitionBy("block", "query_no")
    order = [F.desc("score"), F.asc_nulls_last("vec_id")]
    hits = first.union(further).withColumn("_own", F.row_number().over(W.partitionBy("block", "query_no", "own").orderBy(*order)))
    others = hits.filter(~(F.col("own") & (F.col("_own") == 1)))
    return (
        others.withColumn("rank", F.row_number().over(each.orderBy(*order)))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _floor_list() -> Column:
    """Floors by query number; the least long where a query has none."""
    known = F.col("known")
    numbers = F.sequence(F.lit(0), F.coalesce(F.array_max(F.map_keys(known)), F.lit(0)))
    return F.transform(numbers, lambda i: F.coalesce(F.try_element_at(known, i), F.lit(LONG[0]).cast("long"))).alias("floors")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op4: the five best of all embeddings for each whose vec_id is divisible by 50."""
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    return top_k(rows, F.col("vec_id") % 50 == 0)


ORACLE = f"""
WITH v AS (
  SELECT row_number() OVER () AS no, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.no, a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.no <> b.no AND len(a.q) = len(b.q) AND a.vec_id % 50 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
