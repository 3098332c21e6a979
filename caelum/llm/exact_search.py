"""Exact top-k by inner product: a KD-tree for each shard, best-first search under a propagated kth score."""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caelum.llm.common import cut, table

#: Scores beyond this do not fit a long and take no part.
MOST = (1 << 63) - 1


def build_tree(ids: np.ndarray, points: np.ndarray, leaf: int) -> dict:
    """Median splits along the widest side of each node's tight box, down to ``leaf`` points.

    Nodes are in arrays: box (lo, hi), rows [start, end) of the reordered points, first child (the second
    follows it; 0 for a leaf) and least id. Equal points are split by place, so copies never deepen the tree.
    """
    order = np.argsort(ids, kind="stable")
    lo, hi, start, end, child, least = [], [], [0], [len(ids)], [0], []
    node = 0
    while node < len(start):
        own = order[start[node] : end[node]]
        low, high = points[own].min(0), points[own].max(0)
        lo.append(low)
        hi.append(high)
        least.append(ids[own].min())
        if len(own) > leaf and (high > low).any():
            half = len(own) // 2
            own = own[np.argpartition(points[own, (high - low).argmax()], half)]
            order[start[node] : end[node]] = own
            child[node] = len(start)
            start += [start[node], start[node] + half]
            end += [start[node] + half, end[node]]
            child += [0, 0]
        node += 1
    arrays = {"start": start, "end": end, "child": child, "least": least}
    boxes = {"lo": np.array(lo), "hi": np.array(hi)}
    return {"ids": ids[order], "points": points[order]} | boxes | {k: np.array(v, np.int64) for k, v in arrays.items()}


def exact(x: np.ndarray) -> np.ndarray:
    """Whole numbers held in doubles, as Python's, whose products never overflow."""
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def search_tree(tree: dict, own: int, query: np.ndarray, bounds: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
    """The tree's ``k`` best (score, -id) for one query, without id ``own`` and without scores below ``floor``.

    Nodes are visited by falling bound (the largest inner product their box allows), until no bound beats the kth score.
    """
    best: list[tuple[int, int]] = []
    todo = [(-bounds[0], 0)]
    while todo:
        bound, node = heapq.heappop(todo)
        bound = -bound
        if floor is not None and bound < floor:
            break
        if len(best) == k:
            if bound < best[0][0]:
                break
            if bound == best[0][0] and tree["least"][node] > -best[0][1]:
                continue
        first = tree["child"][node]
        if first:
            for c in (first, first + 1):
                heapq.heappush(todo, (-bounds[c], c))
            continue
        a, b = tree["start"][node], tree["end"][node]
        ids, scores = tree["ids"][a:b], tree["points"][a:b] @ query
        least = max([b[0] for b in best[:1] if len(best) == k] + [floor] * (floor is not None), default=None)
        good = (ids != own) & (np.abs(scores) <= MOST)
        if least is not None:
            good &= scores >= least
        for r in sorted(np.flatnonzero(good), key=lambda r: (-scores[r], ids[r])):
            item = (int(scores[r]), -int(ids[r]))
            if len(best) == k and item <= best[0]:
                break
            twin = next((x for x in best if x[1] == item[1]), None)
            if twin and twin >= item:
                continue
            if twin or len(best) == k:
                best.remove(twin or best[0])
            best.append(item)
            heapq.heapify(best)
    return best


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """Distinct (vec_id, vec, dim): floor(scale * x) of all usable vectors, as doubles, which hold whole numbers of any size."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    small = lambda v: F.abs(v * scale) < float(1 << 53)
    scaled = F.transform(x, lambda v: F.when(small(v), F.floor(v * scale).cast("double")).otherwise(v * scale))  # others are whole
    usable = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(fine)
    return usable.select(F.col("vec_id").cast("long"), scaled.alias("vec"), F.size(x).alias("dim")).where("dim > 0").distinct()


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, shard_rows: int = 8192, leaf: int = 128, group: int = 4096
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row the ``k`` rows of largest integer inner product.

    Ties go to the smaller vec_id; the query's own vec_id is no candidate; with fewer than ``k`` candidates all are
    returned. Vectors that are null, empty, hold null or non-finite components or have no vec_id take no part, nor
    do pairs whose score does not fit a long. Only vectors of the query's length are candidates. Rows equal in id and vector
    count once; where one id has several vectors, its queries are merged and keep the best score of each candidate.

    Shards hold about ``shard_rows`` vectors, dealt by hash, so equal vectors spread out. Queries are dealt into groups of
    about ``group``; one task searches one shard for one group, so its memory is bounded. Each query first searches one
    shard; its kth score there goes with it to all other shards and cuts off boxes that cannot beat it.
    """
    rows = cut(quantised(vectors, scale), "search-vectors")
    asked = rows.where(is_query)
    n = max(rows.count(), 1)
    shards = -(-n // shard_rows)
    groups = -(-max(asked.count(), 1) // group)

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree = build_tree(pdf["vec_id"].to_numpy(), np.stack(pdf["vec"]), leaf)
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "tree": [pickle.dumps(tree)]})

    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(shards)))
    trees = sharded.groupBy("dim", "shard").applyInPandas(build, "dim int, shard long, tree binary")
    trees = cut(trees, "search-trees").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("part", F.col("part").cast("long"))
    queries = asked.select(
        "dim",
        "vec_id",
        "vec",
        F.pmod(F.xxhash64("vec_id", "vec", F.lit(1)), F.lit(groups)).alias("part"),
        F.pmod(F.xxhash64("vec_id", "vec", F.lit(2)), F.lit(shards)).alias("home"),
    )

    def search(trees: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        for raw in trees["tree"]:
            if not len(queries):
                break
            tree = pickle.loads(raw)
            q = np.stack(queries["vec"])
            with np.errstate(over="ignore", invalid="ignore"):
                length = lambda x: np.sqrt((x**2).sum(1).max())
                fits = length(q) * length(tree["points"]) < 2.0**52
            if not fits:  # doubles would round
                q, tree = exact(q), tree | {x: exact(tree[x]) for x in ("points", "lo", "hi")}
            bounds = np.maximum(q, 0) @ tree["hi"].T + np.minimum(q, 0) @ tree["lo"].T
            for row, (own, floor) in enumerate(zip(queries["vec_id"], queries["floor"])):
                floor = None if pd.isna(floor) else int(floor)
                found += [(own, -i, s) for s, i in search_tree(tree, own, q[row], bounds[row], k, floor)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"], dtype="int64")

    keys = ["dim", "shard", "part"]

    def over(asked: DataFrame) -> DataFrame:
        return trees.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")

    def ranked(hits: DataFrame) -> DataFrame:
        hits = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    none = F.lit(None).cast("long")
    seeds = cut(over(queries.withColumn("shard", F.col("home")).withColumn("floor", none)), "search-seeds")
    # An id with several vectors may have its kth score from any of them: only ids with one vector carry it on.
    single = asked.groupBy("vec_id").agg(F.count("*").alias("n")).where("n = 1").select("vec_id")
    floors = ranked(seeds).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    rest = queries.join(floors.join(single, "vec_id", "left_semi"), "vec_id", "left")
    rest = rest.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("shard", F.col("shard").cast("long"))
    return ranked(seeds.union(over(rest.where("shard <> home")))).select("query_id", "rank", "vec_id", "score")


def op6_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


SQL = """
with v as (
  select distinct vec_id, list_transform(embedding, lambda x : floor(256 * cast(x as double))) as vec
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x : x is null or isnan(x) or isinf(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, max(cast(list_inner_product(q.vec, c.vec) as bigint)) as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.vec) = len(c.vec)
  group by all),
r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""
