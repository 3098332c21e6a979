"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caelum.session import cut

__all__ = ["components", "cut", "rows_of", "row_key", "table", "window_hashes"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """``_doc``, ``_th``: what a row is known by. Rows equal in both are one document."""
    return [F.col(doc_id).cast("long").alias("_doc"), F.xxhash64(F.col(text)).alias("_th")]


def rows_of(batches: Iterator[pa.RecordBatch], most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that each holds some ``most`` bytes, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


FACTOR = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every ``n`` consecutive ids."""
    out = np.zeros(len(ids) - n + 1, np.uint64)
    for k in range(n):
        out = (out ^ ids[k : len(ids) - n + 1 + k]) * FACTOR
        out ^= out >> np.uint64(29)
    return out


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges`` (a, b: long) as (id, component), component the least id reached.

    Each round hooks every vertex's root to the least root next to it and then follows roots to
    their roots, so rounds grow with the logarithm of the longest path. Each round's labels are a
    written table. No edges give no rows.
    """
    both = cut(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(),
        f"{name}-edges",
    )
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")), name)
    while True:
        root = labels.select(F.col("id").alias("b"), F.col("component").alias("rb"))
        near = both.join(root, "b").groupBy(F.col("a").alias("id")).agg(F.min("rb").alias("near"))
        moved = labels.join(near, "id").select("id", "component", F.least("component", "near").alias("new"))
        hook = moved.groupBy("component").agg(F.min("new").alias("hook"))
        hooked = moved.join(hook, "component").select("id", F.col("component").alias("old"), F.least("new", "hook").alias("component"))
        jump = hooked.select(F.col("id").alias("component"), F.col("component").alias("next"))
        after = cut(
            hooked.join(jump, "component", "left").select(
                "id", "old", F.coalesce("next", "component").alias("component")
            ),
            name,
        )
        labels = after.select("id", "component")
        if after.where("component <> old").isEmpty():
            return labels
