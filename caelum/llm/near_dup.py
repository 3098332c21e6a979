"""MinHash near-duplicates: bottom-k sketches of one hash function, inverted lists, union sketches, exact Jaccard.

1. Every document becomes a set of shingle hashes. Equal sets form a class; from here on a class is
   one vertex, so exact copies cost one row each.
2. A class keeps its ``k`` smallest hashes. Two sets with Jaccard J share each of the ``k`` smallest hashes of their union
   with chance J, so at J >= 0.8 they share fewer than 30 of 64 with chance below 1e-8 (sets of up to k shingles
   are kept whole). Hence a class with fewer than 30 values that others hold too is out, and of the others
   only the rarest values are listed: the 29 most frequent can be left out, since 30 shared ones must hit the rest.
   That keeps passages which very many documents share out of the lists, without a cap.
3. Inverted lists with the same members are read once. Within a list, members are compared by parity bitmaps
   of their full sets, whose Hamming distance never exceeds the sets' symmetric difference. The first
   pass emits a spanning forest of each list, the second all pairs between what then still are different components.
   Lists above ``block`` members are dealt as pairs of blocks.
4. Emitted pairs meet their full sets: the union sketch estimates Jaccard and drops what is far below, the rest is
   counted exactly. Components of the confirmed links give the groups.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caelum.llm.common import components, cut, row_key, rows_of, table, window_hashes

BITS = 1024
PAD = np.iinfo(np.int64).max


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles_of(text: str | None, n: int, known: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of ``n`` consecutive words; of all words if there are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    return np.unique(window_hashes(ids, min(n, len(words))))


def least_shared(percent: int, k: int, miss: float = 2e-9) -> int:
    """The most values that two sets at ``percent`` per cent Jaccard share of the ``k`` least of their union, but for a chance of ``miss``.

    Each value is shared with that chance, so their number is binomial. Where not even one can be counted on, a larger ``k`` is due.
    """
    q, below = percent / 100, 0.0
    for shared in range(k + 1):
        below += math.comb(k, shared) * q**shared * (1 - q) ** (k - shared)
        if below > miss:
            break
    if not shared:
        raise ValueError(f"sketches of {k} values miss pairs at {percent} per cent with chance {below:.1e}: take more values")
    return shared


def bitmap_of(hashes: np.ndarray) -> bytes:
    """Parities of the counts of hashes by their last ten bits."""
    return np.packbits(np.bincount((hashes & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1).tobytes()


def sketches(docs: DataFrame, words: int, k: int, text: str) -> DataFrame:
    """``_doc, _th, n, d1, d2, sketch, bits`` of every document: set size, digest, k smallest hashes, parities."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in rows_of(batches):
            n, d1, d2, low, bits = [], [], [], [], []
            for value in batch.column(2):
                own = shingles_of(value.as_py(), words, known)
                digest = np.frombuffer(hashlib.blake2b(own.tobytes(), digest_size=16).digest(), np.int64)
                n.append(len(own))
                d1.append(digest[0])
                d2.append(digest[1])
                low.append(own[:k].view(np.int64))
                bits.append(bitmap_of(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(low, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                ["_doc", "_th", "n", "d1", "d2", "sketch", "bits"],
            )

    kinds = "_doc long, _th long, n long, d1 long, d2 long, sketch array<long>, bits binary"
    return docs.select(*row_key(text=text), F.col(text).cast("string").alias("text")).mapInArrow(sketch, kinds)


def inverted_lists(classes: DataFrame, k: int, shared: int) -> tuple[DataFrame, DataFrame]:
    """(value, cid, size): the members of every list worth reading, ``size`` members each; (cid, own): all values of a member."""
    held = classes.select("cid", "slots", F.explode("sketch").alias("value")).repartition("value")
    df = held.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    least = F.ceil(F.col("slots") * shared / k)  # how many values a partner must share
    rare = (
        held.join(df, "value")
        .groupBy("cid", "slots")
        .agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("values"))  # up to k values
        .where(F.size("values") >= least)
        .select("cid", F.slice("values", F.lit(1), (F.size("values") - least + 1).cast("int"))["value"].alias("own"))
    )
    own = cut(rare, "near-lists")
    rare = own.select("cid", F.explode("own").alias("value"))
    lists = rare.groupBy("value").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("cid")).alias("x1"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("x2")
    )
    once = lists.where("size > 1").groupBy("size", "x1", "x2").agg(F.min("value").alias("value"))
    return rare.join(once.select("value", "size"), "value"), own


def near_pairs(lists: DataFrame, percent: int, block: int, width: int, forest: bool) -> DataFrame:
    """Pairs (a, b) of members that may reach ``percent``, from (value, cid, comp, n, bits, own, size).

    ``forest``: spanning trees of the clearly near ones only. Otherwise all pairs of different ``comp`` that
    the bitmaps do not rule out. Of all lists that hold a pair, that of their least common value emits it.
    """
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("cid", F.lit(7)), blocks.cast("long")).cast("int")
    other = F.when(blocks == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), blocks - 1), lambda b: b != own))
    dealt = (
        lists.withColumn("_b", F.explode(other))
        .select("value", F.least("_b", own).alias("i"), F.greatest("_b", own).alias("j"), "cid", "comp", "n", "bits", "own")
        .repartition("value", "i", "j")
        .sortWithinPartitions("value", "i", "j", "cid")
    )

    def may(n, bits, row, rest):
        apart = np.bitwise_count(bits[rest] ^ bits[row]).sum(1, dtype=np.int64) * (100 + percent)
        most = (n[rest] + n[row]) * (100 - percent)
        return apart * 4 <= most * 3 if forest else apart <= most

    def here(value, own, row, rest):
        common = np.isin(own[rest], own[row]) & (own[rest] != PAD)
        return rest[np.where(common, own[rest], PAD).min(1) == value]

    def trees(value, cid, n, bits, own):
        left = np.arange(len(cid))
        while len(left) > 1:
            todo, left = [left[0]], left[1:]
            while todo and len(left):
                row = todo.pop()
                near = may(n, bits, row, left)
                if near.any():
                    todo += left[near].tolist()
                    yield from ((cid[row], cid[x]) for x in here(value, own, row, left[near]))
                    left = left[~near]

    def between(value, cid, comp, n, bits, own):
        for row in range(len(cid) - 1):
            rest = np.flatnonzero(comp[row + 1 :] != comp[row]) + row + 1
            if len(rest):
                rest = rest[may(n, bits, row, rest)]
                if len(rest):
                    yield from ((cid[row], cid[x]) for x in here(value, own, row, rest))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(value, parts):
            cid, comp, n, bits, own = (np.concatenate(x) for x in zip(*parts))
            return trees(value, cid, n, bits, own) if forest else between(value, cid, comp, n, bits, own)

        def groups():
            last, parts = None, []
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys = np.stack([batch.column(c).to_numpy() for c in range(3)], 1)
                columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(3, 6)]
                bits = np.frombuffer(b"".join(batch.column(6).to_pylist()), np.uint64).reshape(batch.num_rows, -1)
                own = np.full((batch.num_rows, width), PAD)
                sizes = batch.column(7).value_lengths().to_numpy()
                own[np.arange(width) < sizes[:, None]] = batch.column(7).flatten().to_numpy()
                ends = [*(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), batch.num_rows]
                start = 0
                for end in ends:
                    key = tuple(keys[start])
                    if key != last and parts:
                        yield last[0], parts
                        parts = []
                    last = key
                    parts.append([*(c[start:end] for c in columns), bits[start:end], own[start:end]])
                    start = end
            if parts:
                yield last[0], parts

        out = []
        for value, parts in groups():
            out += of(value, parts)
            if len(out) > 10_000:
                yield _pairs(out)
                out = []
        if out:
            yield _pairs(out)

    found = dealt.mapInArrow(pairs, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _pairs(out):
    a, b = np.array(out, np.int64).T
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def full_sets(docs: DataFrame, wanted: DataFrame, words: int, text: str) -> DataFrame:
    """(cid, hashes) of the classes in ``wanted`` (cid, _doc, _th), counted again from the texts."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in rows_of(batches):
            own = [shingles_of(v.as_py(), words, known).tobytes() for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], ["cid", "hashes"])

    keyed = docs.select(*row_key(text=text), F.col(text).cast("string").alias("text"))
    # Texts always move by key: a join that fits a broadcast at small sizes only would say nothing of large ones.
    texts = keyed.hint("merge").join(wanted, keyed["_doc"].eqNullSafe(wanted["_doc"]) & (keyed["_th"] == wanted["_th"]))
    return texts.select("cid", "text").mapInArrow(sets, "cid long, hashes binary").dropDuplicates(["cid"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union."""
    both = pairs.join(sets.select(F.col("cid").alias("a"), F.col("hashes").alias("ha")), "a").join(
        sets.select(F.col("cid").alias("b"), F.col("hashes").alias("hb")), "b"
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            keep = []
            for ha, hb in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(h.as_buffer(), np.uint64) for h in (ha, hb))
                union = np.union1d(x[:k], y[:k])[:k]
                likely = np.isin(union, x[:k]) & np.isin(union, y[:k])
                if likely.mean() < percent / 100 - 0.3:
                    keep.append(False)
                    continue
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "ha", "hb").mapInArrow(check, "a long, b long")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, k: int = 64, shared: int | None = None, block: int = 2048, text: str = "text"
) -> DataFrame:
    """``_doc, _th, rid, n, group, component`` of every row: its shingles, its group (a rid) and the least doc_id of that.

    Rows whose sets reach ``percent`` per cent Jaccard are linked, groups are what links connect. Null and empty
    texts, and texts of white space, have no shingles and are linked with nothing. ``shared`` values of ``k`` must be common to a
    pair; by default as many as pairs at ``percent`` have (``least_shared``), which is an error if that is none. Null doc_ids belong to groups but
    never name one that has another member. Repeated rows are members like others. An empty table gives no rows.
    """
    shared = shared or least_shared(percent, k)
    rows = cut(sketches(docs, words, k, text).withColumn("rid", F.monotonically_increasing_id()), "near-rows")
    full = rows.where("n > 0")
    heads = full.groupBy("d1", "d2").agg(F.min("rid").alias("cid"), F.min("_doc").alias("doc"))
    heads = cut(heads, "near-classes")
    reps = full.withColumnRenamed("rid", "cid").join(heads.select("cid"), "cid", "left_semi")
    lists, own = inverted_lists(reps.select("cid", "sketch", F.size("sketch").alias("slots")), k, shared)
    lists = cut(lists, "near-members")
    members = lists.select("cid").distinct()
    about = full.select(F.col("rid").alias("cid"), "_doc", "_th", "n", "bits").join(members, "cid")
    about = cut(about, "near-about")
    sets = cut(full_sets(docs, about.select("cid", "_doc", "_th"), words, text), "near-sets")
    facts = about.select("cid", "n", "bits").join(own, "cid")

    first = near_pairs(lists.join(facts, "cid").withColumn("comp", F.lit(0).cast("long")), percent, block, k, True)
    links = cut(confirmed(first, sets, percent, k), "near-links")
    labels = components(links, "near-comp")
    comp = F.coalesce("component", "cid").alias("comp")
    labelled = lists.join(labels.withColumnRenamed("id", "cid"), "cid", "left").select("value", "cid", "size", comp)
    open_lists = labelled.groupBy("value").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y")
    rest = labelled.join(open_lists.select("value"), "value", "left_semi").join(facts, "cid")
    more = cut(confirmed(near_pairs(rest, percent, block, k, False), sets, percent, k), "near-links")
    labels = components(links.union(more), "near-comp")

    named = labels.withColumnRenamed("id", "cid").join(heads.select("cid", "doc"), "cid")
    names = named.groupBy("component").agg(F.min("doc").alias("name"))
    named = named.join(names, "component").select("cid", "name", F.col("component").alias("label"))
    of_class = heads.join(named, "cid", "left").select("d1", "d2", F.coalesce("label", "cid").alias("group"), F.coalesce("name", "doc").alias("component"))
    narrow = rows.select("_doc", "_th", "rid", "n", "d1", "d2")
    return narrow.join(of_class, ["d1", "d2"], "left").select(
        "_doc",
        "_th",
        "rid",
        "n",
        F.when(F.col("n") == 0, F.col("rid")).otherwise(F.col("group")).alias("group"),
        F.when(F.col("n") == 0, F.col("_doc")).otherwise(F.col("component")).alias("component"),
    )


def one_of_each(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that of the least doc_id (of these, of the least text hash); its columns stay.

    Null doc_ids come last. A doc_id only orders: unrelated texts that share one, or have none, all stay. Texts without words stay; of rows equal in doc_id and text one stays.
    """
    text = parameters.get("text", "text")
    rows = near_duplicates(docs, **parameters)
    first = rows.where("n > 0").groupBy("group").agg(F.min(F.struct(F.col("_doc").isNull(), "_doc", "_th")).alias("first"))
    stay = first.select("first._doc", "first._th").union(rows.where("n = 0").select("_doc", "_th").distinct())
    # Grouping and join share keys without NULLs, so each text moves once; copies of a row meet before they move.
    key = [F.coalesce("_doc", F.lit(0)).alias("_k"), F.col("_doc").isNull().alias("_n"), "_th"]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    once = docs.select(*row_key(text=text), row).select(*key, "_row").groupBy("_k", "_n", "_th").agg(F.first("_row").alias("_row"))
    return once.join(stay.select(*key), ["_k", "_n", "_th"], "left_semi").select("_row.*")


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=4)
    return rows.select(
        F.col("_doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("_doc").eqNullSafe(F.col("component")).alias("kept"),
    )
