"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caelum.llm.common import cut, row_key, rows_of, table, window_hashes
from caelum.llm.near_dup import WordHashes

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")
BITS = 20


def ids_of(text: str | None, known: WordHashes) -> np.ndarray:
    tokens = TOKEN.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []
    return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))


def slots_of(ids: np.ndarray) -> np.ndarray:
    """Distinct slots of the words, runs of signs and pairs of neighbours of a text, in lower case.

    A slot counts once for a document, so a document that repeats a word weighs no more in the models than another.
    """
    grams = [window_hashes(ids, n) for n in (1, 2) if len(ids) >= n]
    return np.unique(np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.int64) if grams else np.zeros(0, np.int64)


def repeats_of(ids: np.ndarray, known: WordHashes) -> list[int]:
    """Slots that say how a text repeats itself: its longest run of one token, and the shares of tokens equal to the one before and of repeated pairs.

    A slot stands for "so much or more", so all that repeat more are counted together. Their names are no tokens.
    """
    if len(ids) < 2:
        return []
    same = ids[1:] == ids[:-1]
    run = np.diff(np.flatnonzero(np.concatenate(([True], ~same, [True])))).max()
    share, pairs = same.mean(), window_hashes(ids, 2)
    again = 1 - len(np.unique(pairs)) / len(pairs)
    names = [b" run %d" % k for k in range(2, 8) if run >= 2**k]
    names += [b" same %d" % k for k in range(1, 7) if share >= k / 8] + [b" again %d" % k for k in range(1, 8) if again >= k / 8]
    return [known[name] >> (64 - BITS) for name in names]


def features_of(text: str | None, known: WordHashes) -> tuple[np.ndarray, int]:
    """Distinct slots of a text, those of its repetitions included, and how many there are without these."""
    ids = ids_of(text, known)
    own, more = slots_of(ids), repeats_of(ids, known)
    return (np.union1d(own, np.array(more, np.int64)) if more else own), len(own)


class Model(NamedTuple):
    """``logs``: by slot the weights for documents outside and inside the target; ``ids``: the target's doc_ids, sorted; ``unit``: a weight's unit."""

    logs: np.ndarray
    ids: np.ndarray
    unit: float = 1.0

    def inside(self, ids: pa.Array) -> np.ndarray:
        return np.isin(ids.fill_null(0).to_numpy(), self.ids) & ids.is_valid().to_numpy(zero_copy_only=False)


def log_ratios(raw: np.ndarray, target: np.ndarray, share: float, odds: float) -> np.ndarray:
    """Shrunk log ratios of target to raw model by slot, for documents outside (row 0) and inside the target (row 1).

    A document is left out of the counts that weigh it, so n-grams that only it has weigh 0, good or not. Both models are smoothed by
    one count. ``share`` of the raw counts is expected in the target, times the median ratio of the target's n-grams: raw text
    holds some rejects, which raises all ratios of good text alike and would only reward length. Each log ratio is multiplied by the chance
    that the slot tells target and raw apart, with ``odds`` against it before and the likelihood ratio of its counts (the target as a draw from raw).
    """
    seen = np.flatnonzero(target)
    ratio = np.log(target[seen] / ((raw[seen] - 1) * share + 1))
    order = np.argsort(ratio, kind="stable")
    sums = np.cumsum(target[seen][order])
    share = min(share * math.exp(ratio[order][np.searchsorted(sums, sums[-1] / 2)]), 1 - 1e-6)
    logs = np.zeros((2, len(raw)))
    for inside in (0, 1):
        n, expected = np.maximum(target - inside, 0), np.maximum(raw - 1, 0) * share
        rest, others = np.maximum(raw - inside, 0) - n, np.maximum(raw - 1, 0) * (1 - share)
        gain = n * np.log(np.maximum(n, 1) / np.maximum(expected, 1e-9)) + rest * np.log(np.maximum(rest, 1) / np.maximum(others, 1e-9))
        logs[inside] = np.log((n + 1) / (expected + 1)) / (1 + odds * np.exp(-np.clip(gain, 0, 600)))
    return logs


def verdicts(labels: DataFrame) -> DataFrame:
    """doc_id, good (1 or 0) of the labelled documents. Good: every label of the doc_id says quality 1 and not toxic."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    named = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return named.agg(F.min(F.coalesce(good, F.lit(False)).cast("int")).alias("good"))


def fit(docs: DataFrame, labels: DataFrame, bound: int, odds: float, text: str) -> Model | None:
    """The model: counts of all of ``docs`` against those of at most ``bound`` documents labelled good; None without these.

    The ``bound`` least by hash are taken; their ids are sent out, and the model, which has 2**BITS slots. The driver gets the counts.
    """
    chosen = verdicts(labels).where("good = 1")
    ids = [r[0] for r in chosen.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).collect()]
    model = Model(np.zeros((2, 0)), np.sort(np.array(ids, np.int64)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last slot counts documents.
        known, sums, held = WordHashes(), np.zeros((2, (1 << BITS) + 1), np.int64), [[], []]

        def add():
            for k in (0, 1):
                if held[k]:
                    sums[k] += np.bincount(np.concatenate(held[k]), minlength=(1 << BITS) + 1)
                    sums[k, -1] += len(held[k])
                    held[k].clear()

        for batch in rows_of(batches):
            for value, own in zip(batch.column(1), shared.value.inside(batch.column(0))):
                slots, n = features_of(value.as_py(), known)
                if n:
                    held[0].append(slots)
                    if own:
                        held[1].append(slots)
            add()
        at = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, sums[0, at], sums[1, at])], ["slot", "raw", "target"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string")).mapInArrow(count, "slot long, raw long, target long")
    counts = rows.groupBy("slot").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    sums = np.zeros((2, (1 << BITS) + 1), np.int64)
    for k, name in enumerate(("raw", "target")):
        sums[k, counts["slot"].to_numpy()] = counts[name].to_numpy()
    (raw, target), (all_docs, good) = sums[:, :-1], sums[:, -1]
    return model._replace(logs=log_ratios(raw, target, good / all_docs, odds)) if good else None


def weighted(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` without its column ``_text``, with ``_weight``, the log importance weight, and ``_n``, its distinct n-grams.

    The weight is the sum of the log ratios over the root of their number, which is how the noise of such sums grows with length.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or Model(np.zeros((2, 1 << BITS)), np.zeros(0, np.int64)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = WordHashes(), shared.value
        for batch in rows_of(batches):
            at, doc = (batch.schema.get_field_index(c) for c in ("_text", "_doc"))
            found = [features_of(v.as_py(), known) for v in batch.column(at)]
            weights = [float(model.logs[int(own), s].sum()) / math.sqrt(max(n, 1)) for (s, n), own in zip(found, model.inside(batch.column(doc)))]
            columns = [*(c for k, c in enumerate(batch.columns) if k != at), pa.array(weights, pa.float64()), pa.array([n for _, n in found], pa.int64())]
            names = [n for n in batch.schema.names if n != "_text"] + ["_weight", "_n"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "_text")
    return docs.mapInArrow(weigh, f"{kinds}, _weight double, _n long")


def best_floor(scored: DataFrame, labels: DataFrame) -> float:
    """The weight below which the fewest labelled documents are put wrong; minus infinity unless some are good and some are not.

    Weights count in steps of 1e-4, between -5 and 5. Of equal cuts the lowest is taken.
    """
    bin_ = F.floor(F.greatest(F.lit(-5.0), F.least(F.lit(5.0), "_weight")) * 10_000).cast("long")
    named = scored.where("_n > 0").select(F.col("_doc").alias("doc_id"), bin_.alias("bin")).join(verdicts(labels), "doc_id")
    counts = sorted(named.groupBy("bin").agg(F.sum("good"), F.count("*")).collect())  # at most 100,001 rows
    lost, left = 0, sum(n - good for _, good, n in counts)
    if not left or left == sum(n for _, _, n in counts):
        return -math.inf
    least, floor = left, -math.inf
    for k, (b, good, n) in enumerate(counts[:-1]):
        lost, left = lost + good, left - (n - good)
        if lost + left < least:
            least, floor = lost + left, (b + 1 + counts[k + 1][0]) / 20_000
    return floor


def gumbel_key(temperature: float, seed: int, model: Model | None):
    """Weight, in its unit, plus Gumbel noise as a whole number; the noise is a hash of the row, so a task run again draws it again."""
    u = (F.shiftrightunsigned(F.xxhash64("_doc", "_th", F.lit(seed)), 12).cast("double") + 0.5) / float(1 << 52)
    return F.round((F.col("_weight") / (temperature * (model.unit if model else 1.0)) - F.log(-F.log(u))) * (1 << 20)).cast("long")


def kth_largest(keys: DataFrame, k: int, bins: int = 4096) -> int | None:
    """The kth largest ``key``: counts by equal bins, then within the bin that holds it, until a bin is one number wide."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None or k < 1:
        return None
    while low < high:
        width = -(-(high - low + 1) // bins)
        bin_ = F.floor((F.col("key") - low) / width).cast("long")
        counts = dict(keys.where(F.col("key").between(low, high)).groupBy(bin_.alias("b")).count().collect())  # at most ``bins`` rows
        for b in sorted(counts, reverse=True):
            if k <= counts[b]:
                break
            k -= counts[b]
        low, high = low + b * width, min(high, low + (b + 1) * width - 1)
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    size: int | None = None,
    floor: float | None = None,
    temperature: float = 0.02,
    bound: int = 20_000,
    odds: float = 10_000.0,
    seed: int = 0,
    text: str = "text",
) -> tuple[DataFrame, Model | None, int | None]:
    """``_doc, _th, _weight, _n, key`` of every row (written), the model, and the key from which rows are sampled.

    All n-grams of a document weigh, by shrunk log ratios; rows are sampled without replacement, with chances as the weights
    to the power 1 / ``temperature``, by taking the ``size`` largest keys (weight / temperature + Gumbel noise). Without
    ``size`` it is the number of rows of weight ``floor`` or more, so about as many are kept as are good; without ``floor`` that
    is the cut at which the fewest labelled documents, good or not, are on the wrong side. Weights count in units of the floor's distance from 0. Rows equal in
    doc_id and text, and keys that tie at the last place, are sampled together. Null and empty texts weigh 0. Labels of
    unknown documents, with null doc_id, or none at all, teach nothing; without a target all weights are 0.
    """
    model = fit(docs, labels, bound, odds, text)
    rows = docs.select(*row_key(text=text), F.col(text).cast("string").alias("_text"))
    scored = cut(weighted(rows, model), "quality")
    if floor is None:
        floor = best_floor(scored, labels)
    if model and math.isfinite(floor):
        model = model._replace(unit=max(abs(floor), 1e-4))
    scored = scored.withColumn("key", gumbel_key(temperature, seed, model))
    if size is None:
        size = scored.where(F.col("_weight") >= floor).count()
    return scored, model, kth_largest(scored, size)


def sample(docs: DataFrame, labels: DataFrame, temperature: float = 0.02, seed: int = 0, text: str = "text", **parameters) -> DataFrame:
    """The sampled rows of ``docs`` with their columns. Weights are computed again beside each row, so no text is shuffled."""
    _, model, last = resample(docs, labels, temperature=temperature, seed=seed, text=text, **parameters)
    if last is None:
        return docs.limit(0)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(row, *row_key(text=text), F.col(text).cast("string").alias("_text"))
    kept = weighted(keyed, model).withColumn("_key", gumbel_key(temperature, seed, model)).where(F.col("_key") >= last)
    return kept.select("_row.*")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _, last = resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select(
        F.col("_doc").alias("doc_id"),
        F.col("_n").alias("n_grams"),
        F.round("_weight", 6).alias("log_weight"),
        (F.col("key") >= (0 if last is None else last)).alias("kept"),
    )
