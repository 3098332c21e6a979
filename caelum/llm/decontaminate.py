"""Benchmark decontamination: sets of benchmark n-grams go to every executor, documents are scanned in place."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caelum.llm.common import cut, rows_of, table, window_hashes

#: Lower-cases A-Z, keeps a-z, 0-9 and every byte of a non-ASCII character; the rest parts words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
BITS = 20


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


@dataclass
class Grams:
    """The windows of a block of benchmark items, as arrays."""

    vocabulary: dict[bytes, int]
    ids: np.ndarray  # all items' words, one after the other
    items: list[str | None]
    lengths: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # by window length: filter, sorted hashes, places, items


def grams_of(rows: list[tuple[object, str | None]], n: int) -> Grams:
    vocabulary: dict[bytes, int] = {}
    ids, items, by_length, start = [], [], {}, 0
    for item, text in rows:
        own = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        if not own:
            continue
        size = min(n, len(own))
        by_length.setdefault(size, []).extend((start + k, len(items)) for k in range(len(own) - size + 1))
        items.append(None if item is None else str(item))
        ids += own
        start += len(own)
    all_ids = np.array(ids, np.uint64)
    lengths = {}
    for size, pairs in by_length.items():
        places, owners = np.array(pairs, np.int64).T
        hashes = window_hashes(all_ids, size)[places]
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        seen = np.zeros(1 << BITS, bool)
        seen[hashes >> np.uint64(64 - BITS)] = True
        lengths[size] = (seen, hashes, places[order], owners[order])
    return Grams(vocabulary, all_ids, items, lengths)


def hits_of(words: list[bytes], grams: Grams) -> tuple[list[tuple[int, int]], set[int]]:
    """The word spans [start, end) of every window's occurrences, and the items they belong to."""
    known = grams.vocabulary.get
    ids = np.fromiter((known(w, 0) for w in words), np.uint64, len(words))
    unknown = np.concatenate(([0], np.cumsum(ids == 0)))
    spans, items = [], set()
    for size, (seen, hashes, places, owners) in grams.lengths.items():
        if len(words) < size:
            continue
        starts = np.flatnonzero(unknown[size:] == unknown[:-size])  # windows of known words only
        if not len(starts):
            continue
        own = window_hashes(ids, size)[starts]
        maybe = seen[own >> np.uint64(64 - BITS)]
        starts, own = starts[maybe], own[maybe]
        left, right = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
        for at, a, b in zip(starts.tolist(), left.tolist(), right.tolist()):
            found = [k for k in range(a, b) if np.array_equal(grams.ids[places[k] : places[k] + size], ids[at : at + size])]
            if found:
                spans.append((at, at + size))
                items.update(owners[found].tolist())
    return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


FOUND = "struct<n_words:long,spans:array<struct<start:long,end:long>>,items:array<string>>"


def _scan(docs: DataFrame, grams: Grams, text: str) -> DataFrame:
    """Fills or widens the last column: words, spans of hit words and items of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(grams)
    at = docs.columns.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = shared.value
        for batch in rows_of(batches):
            found = []
            for value, before in zip(batch.column(at), batch.column(batch.num_columns - 1)):
                before = before.as_py() or {"spans": [], "items": []}
                words = words_of(value.as_py())
                spans, items = hits_of(words, grams)
                spans = merged(spans + [(s["start"], s["end"]) for s in before["spans"]])
                items = {grams.items[k] for k in items} | {*before["items"]}
                found.append(
                    {"n_words": len(words), "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(items - {None})}
                )
            kind = batch.schema.field(batch.num_columns - 1).type
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, kind)], schema=batch.schema)

    return docs.mapInArrow(scan, docs.schema)


def scan_benchmark(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text", block_bytes: int = 1 << 22) -> DataFrame:
    """``docs`` and a last column (n_words, spans of hit words, items), named ``_found`` unless ``docs`` has that name.

    A window is ``n`` consecutive words of an item, or all of a shorter item. Items are dealt by hash into as many blocks
    as keep each block's text below ``block_bytes``, the size that is measured before anything is sent; one block
    at a time goes to the driver and to the executors, and each block's scan continues from the written result of the
    one before. So memory is bounded whatever the size of the benchmark, and documents are never shuffled.
    A single item above the bound makes a block of its own.
    """
    name = "_found"
    while name in [c.lower() for c in docs.columns]:  # Spark does not tell names apart by case
        name += "_"
    docs = docs.withColumn(name, F.lit(None).cast(FOUND))
    items = benchmark.select("item_id", F.col("text").alias("_text")).where("_text is not null")
    size = F.sum(F.octet_length("_text"))
    total = items.agg(size.alias("b")).first()["b"] or 0
    blocks = 1
    while total > block_bytes:
        blocks = max(2 * blocks, -(-total * 2 // block_bytes))
        dealt = items.groupBy(F.pmod(F.xxhash64("item_id", "_text"), F.lit(blocks)).alias("block"))
        if dealt.agg(size.alias("b"), F.countDistinct("_text").alias("n")).where(f"b > {block_bytes} and n > 1").isEmpty():
            break
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "_text"), F.lit(blocks)) == block)
        docs = _scan(docs if block == 0 else cut(docs, "decontaminate"), grams_of([tuple(r) for r in part.distinct().collect()], n), text)
    return docs


def report(found: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of scanned documents."""
    name = found.columns[-1]
    hit = F.aggregate(f"{name}.spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        F.col(f"{name}.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size(f"{name}.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(f"{name}.items")), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "documents", text: str = "text", block_bytes: int = 1 << 22
) -> DataFrame:
    """``docs`` without what the benchmark holds; the columns stay as they are.

    ``remove="documents"`` drops every document with a hit word; ``remove="spans"`` keeps it and cuts each hit
    span, from its first to its last word's byte, out of the text, leaving one space. Null and empty
    texts have no words and stay. Repeated rows are each treated alike. An empty benchmark changes nothing. Items
    with a null id count as hits but are never listed.
    """
    found = scan_benchmark(docs, benchmark, n, text, block_bytes)
    if remove == "documents":
        return found.where(F.size(f"{found.columns[-1]}.spans") == 0).select(*[f"`{c}`" for c in docs.columns])
    at = docs.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            texts = [
                without_spans(v.as_py(), [(s["start"], s["end"]) for s in f.as_py()["spans"]])
                for v, f in zip(batch.column(at), batch.column(batch.num_columns - 1))
            ]
            columns = [*batch.columns[:-1]]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(batch.schema)[:-1]))

    return found.mapInArrow(clean, docs.schema)


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    if not spans:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    clear, ends, at = raw.translate(WORD_BYTES), [], 0
    for word in clear.split():
        start = clear.index(word, at)
        at = start + len(word)
        ends.append((start, at))
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : ends[a][0]].rstrip())
        at = ends[b - 1][1]
    out.append(raw[at:].lstrip())
    return b" ".join(x for x in out if x).decode("utf-8", "surrogatepass")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return report(scan_benchmark(docs, table(spark, sf_dir, "benchmark")))
