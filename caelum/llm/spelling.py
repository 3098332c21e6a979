"""Spelling variants: words one edit apart, found by a variable-length gram index, and the common form of each."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caelum.llm.common import FACTOR, cut, rows_of, table

#: Runs of letters, after A-Z have been lower-cased.
RUN = "[a-zÀ-ÿ]{%d,}"
CELLS = 1 << 18


# ------------------------------------------------------------------ words and their numbers


def counted(docs: DataFrame, least_chars: int, misspelt: int, text: str = "text", most_held: int = 400_000) -> DataFrame:
    """``word, n``: how often each word of ``least_chars`` or more occurs, over all texts.

    Where ``misspelt`` divides the crc32 of doc_id and run, the run loses the letter at crc32 modulo its length. That is so for
    all of a document's equal runs, so it is worked out once for them. Tasks add up first and send what they hold whenever
    it exceeds ``most_held`` words.
    """
    run = re.compile(RUN % least_chars)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()

        for batch in rows_of(batches):
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                runs = run.findall((value.as_py() or "").encode().lower().decode())
                if not runs:
                    continue
                prefix = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                hits = [r for r in {*runs} if not zlib.crc32(r.encode(), prefix) % misspelt]
                held.update(runs)
                for r in hits:
                    n = runs.count(r)
                    held[r] -= n
                    if not held[r]:
                        del held[r]
                    if len(r) > least_chars:
                        at = zlib.crc32(r.encode(), prefix) % len(r)
                        held[r[:at] + r[at + 1 :]] += n
            if len(held) > most_held:
                yield from out()
        yield from out()

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ the gram index


def dictionary(words: DataFrame, shortest: int, longest: int, listed: int, most_grams: int, most_held: int = 400_000) -> tuple[frozenset[str], np.ndarray]:
    """The frequent grams, which are lengthened, and how frequent any gram is, by the crc32 of it.

    Frequent are grams of ``shortest`` to ``longest`` - 1 letters in more than a threshold of places: ``listed``, or as much
    higher as keeps them below ``most_grams`` whatever the words, since all have no more places than were counted. Numbers of
    places are kept for ``CELLS`` cells of the crc32, the greatest of a cell. So what goes to all tasks has a bound.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["gram", "n"])
            held.clear()

        for batch in rows_of(batches):
            for value in batch.column(0):
                w = value.as_py()
                for q in range(shortest, longest + 1):
                    held.update([w[p : p + q] for p in range(len(w) - q + 1)])
                if len(held) > most_held:
                    yield from out()
        yield from out()

    grams = cut(words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    places = grams.agg(F.sum("n")).first()[0] or 0
    threshold = max(listed, -(-places // most_grams))
    longer = grams.where((F.length("gram") < longest) & (F.col("n") > threshold)).collect()
    cells = grams.groupBy((F.crc32(F.col("gram").cast("binary")) % CELLS).alias("cell")).agg(F.max("n").alias("n")).collect()
    ranks = np.zeros(CELLS, np.int64)
    ranks[[r["cell"] for r in cells]] = [r["n"] for r in cells]
    return frozenset(r["gram"] for r in longer), ranks


def tails(grams: frozenset[str]) -> frozenset[str]:
    """What frequent grams end with after at least one letter."""
    return frozenset(g[k:] for g in grams for k in range(1, len(g)))


def decompose(word: str, grams: frozenset[str], shortest: int, longest: int) -> tuple[list[tuple[int, int]], bool]:
    """The word's variable-length grams as (start, end), and whether the last would go on if the word did.

    At each place a gram is lengthened, up to ``longest``, while it is frequent; of these, one that lies within an earlier one is
    left out.
    """
    out, reach, open_ = [], 0, False
    for p in range(len(word) - shortest + 1):
        q = shortest
        while q < longest and p + q < len(word) and word[p : p + q] in grams:
            q += 1
        if p + q > reach:
            reach = p + q
            out.append((p, reach))
            open_ = reach == len(word) and q < longest and word[p:] in grams
    return out, open_


def touching(word: str, part: tuple[int, int], goes_on: bool, ends: frozenset[str], longest: int) -> int:
    """The edits that may change a gram of a word, as bits: 2 i replaces or deletes letter ``i``, 2 i + 1 inserts before it.

    Those are edits of its letters, insertions between them, and one at the word's end if the gram ends there and might go on. And
    it may vanish into an earlier gram that an edit before it has changed and that has then grown through its letters: only
    if the letters from the edit on, but for the last, end a frequent gram. After any other edit the gram is still there, at the
    same distance from the word's start (if the edit is behind it) or from its end (if before it).
    """
    p, e = part
    bits = (1 << (2 * e)) - (1 << (2 * p)) & ~(1 << (2 * p + 1))
    if goes_on and e == len(word):
        bits |= 1 << (2 * e + 1)
    for i in range(max(0, e - 1 - longest), p + 1):
        if word[i : e - 1] in ends:
            bits |= 1 << (2 * i + 1)
            if i:
                bits |= 1 << (2 * i - 2)
    return bits


def keys_of(word: str, grams: frozenset[str], ends: frozenset[str], ranks: np.ndarray, shortest: int, longest: int) -> tuple[list[tuple], bool]:
    """(gram, side, distance) of the lists in which a word meets words one edit away, and whether it meets them all.

    Of two near words each shares all but its changed grams with the other. So the rarest shared gram is among the rarest of each
    up to the first after which no single edit changes all of them: that many lists are merged. A word that has no such
    number need not meet another word that has none.
    """
    parts, goes_on = decompose(word, grams, shortest, longest)
    found, edits = [], -1
    named = [(word[p:e], p, e) for p, e in parts]
    for _, g, p, e in sorted((ranks[zlib.crc32(g.encode()) % CELLS], g, p, e) for g, p, e in named):
        found += [(g, 0, p), (g, 1, len(word) - e)]
        edits &= touching(word, (p, e), goes_on, ends, longest)
        if not edits:
            return found, True
    return found, False


def odd_letters(word: str) -> int:
    """The letters, modulo 64, that occur an odd number of times, as bits of a signed long. One edit changes two of them at most."""
    bits = 0
    for c in word:
        bits ^= 1 << (ord(c) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def postings(words: DataFrame, grams: frozenset[str], ranks: np.ndarray, shortest: int, longest: int) -> DataFrame:
    """``key, role, odd, word, n``: the entries of the lists to merge.

    A list is of one gram, side, distance and word length. With role 0 a word looks for words as long as itself or longer by
    one; with role 1 it is found, at its own length (one side will do) and at the length less one. A word that is not
    sure to meet all its neighbours by the dictionary is entered again with shorter grams, at last with those of ``shortest``
    letters alone, by which it is.
    """
    levels = [(q, own := frozenset(g for g in grams if len(g) < q), tails(own)) for q in range(longest, shortest - 1, -1)]
    entered = {0: ((0, 0), (1, 0), (1, 1)), 1: ((0, 0), (1, 1))}  # by side: role, and by how much the list's words are shorter

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 1 << 18):
            rows, roles, crcs, places, odd = [], [], [], [], []
            for row, value in enumerate(batch.column(0)):
                w = value.as_py()
                odd.append(odd_letters(w))
                for level, (q, own, ends) in enumerate(levels):
                    found, sure = keys_of(w, own, ends, ranks, shortest, q)
                    for gram, side, at in found:
                        crc = zlib.crc32(gram.encode())
                        for role, less in entered[side]:
                            rows.append(row)
                            roles.append(role)
                            crcs.append(crc)
                            places.append((2 * level + side, at, len(w) - less))
                    if sure:
                        break
            if rows:
                key = np.array(crcs, np.uint64)
                for part in np.array(places, np.uint64).T:
                    key = (key ^ part) * FACTOR
                    key ^= key >> np.uint64(29)
                rows = pa.array(rows)
                taken = [c.take(rows) for c in (pa.array(odd, pa.int64()), batch.column(0), batch.column(1))]
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(roles, pa.int8()), *taken], ["key", "role", "odd", "word", "n"])

    return words.select("word", "n").mapInArrow(entries, "key long, role byte, odd long, word string, n long")


def near_words(words: DataFrame, grams: frozenset[str], ranks: np.ndarray, shortest: int, longest: int) -> DataFrame:
    """``word, n, other, other_n`` for words that differ by exactly one inserted, deleted or replaced letter, both ways round."""
    lists = cut(postings(words, grams, ranks, shortest, longest), "gram-lists")
    side = lambda role, x: lists.where(F.col("role") == role).select("key", *[F.col(c).alias(x + c) for c in ("odd", "word", "n")])
    a, b = F.col("a_word"), F.col("b_word")
    oriented = (F.length(a) < F.length(b)) | (a < b)
    # most of those that meet are told apart by their letters; the others are verified
    alike = F.bit_count(F.col("a_odd").bitwiseXOR(F.col("b_odd"))) <= 2
    met = side(0, "a_").join(side(1, "b_"), "key").where(alike & oriented & (F.levenshtein(a, b, 1) == 1))
    pair = lambda x, y: F.struct(F.col(f"{x}_word").alias("word"), F.col(f"{x}_n").alias("n"), F.col(f"{y}_word").alias("other"), F.col(f"{y}_n").alias("other_n"))
    return met.select(F.explode(F.array(pair("a", "b"), pair("b", "a"))).alias("_p")).select("_p.*").distinct()


# ------------------------------------------------------------------ forms


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of (word, form): forms followed to the last. Each round doubles the steps taken.

    A form is many times as frequent as its word, so no chain is longer than the number of digits of a count.
    """
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        after = cut(reached.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        reached = after.select("word", "root")
        if after.where("_moved").isEmpty():
            return reached


def variants(
    docs: DataFrame,
    least_chars: int = 7,
    least_n: int = 2,
    times: int = 10,
    misspelt: int = 31,
    grams: tuple[int, int] = (3, 4),
    listed: int = 2000,
    most_grams: int = 200_000,
    text: str = "text",
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``least_chars`` letters that occurs ``least_n`` times.

    Words are maximal runs of letters (a-z after A-Z are lower-cased, and U+00C0 to U+00FF) of whole texts; in one of ``misspelt``
    runs, by crc32 of doc_id and run, a letter is left out. Near words differ by one letter inserted, deleted or replaced. A
    word's ``form`` is its most frequent near word, of equal ones the first in code-point order, if that is ``times`` as
    frequent, else null; ``root`` is the last form of the chain, or the word.

    Null and empty texts have no words; a null doc_id counts as empty in the crc32; repeated rows count each; words of any length
    are compared; other columns are left out; an empty table gives no rows. ``grams`` are the least and greatest gram lengths;
    ``least_chars`` must be twice the least, or a word may share no gram with a near one. The dictionary sent to tasks holds
    fewer than ``most_grams`` grams whatever the texts.
    """
    shortest, longest = grams
    if least_chars < 2 * shortest or longest < shortest:
        raise ValueError("words must have twice the letters of the shortest gram")
    words = cut(counted(docs, least_chars, misspelt, text).where(F.col("n") >= least_n), "words")
    pairs = near_words(words, *dictionary(words, shortest, longest, listed, most_grams), shortest, longest)
    best = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other"))).alias("_best")
    found = pairs.groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    enough = -F.col("_best.m") >= times * F.col("n")
    found = cut(
        found.select("word", "n_near", F.when(enough, F.col("_best.other")).alias("form"), F.when(enough, -F.col("_best.m")).alias("form_n")), "forms"
    )
    out = words.join(found, "word", "left").join(roots(found.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents").select("doc_id", "text"))
