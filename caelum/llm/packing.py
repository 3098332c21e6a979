"""Packing of token sequences: best fit in blocks, then local search that exchanges documents between underfull sequences."""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caelum.llm.common import cut, rows_of, table

#: White space of the tokenizer, between which it never joins anything. ``str.split`` also splits at U+001C to U+001F.
BLANK = "\t-\r \x85\xa0  -     　"
NEXT_BLANK = re.compile(f"[{BLANK}]")
WORDS = re.compile(f"[^{BLANK}]+")
SEPARATORS = re.compile("[\x1c-\x1f]")
#: A run of letters between marks: each of the three is encoded by itself. Apostrophes begin suffixes such as 's, and < | > may
#: be a special token, so words with these are left whole.
PLAIN = re.compile(r"([!-&(-/:;=?@\[-`{}~]*)([a-zß-öø-ÿ]+)([!-&(-/:;=?@\[-`{}~]*)")


# ------------------------------------------------------------------ tokens


def slices_of(text: str, most: int) -> Iterator[str]:
    """``text`` in slices of about ``most`` characters that end before white space; longer where there is none."""
    start = 0
    while len(text) - start > most:
        at = NEXT_BLANK.search(text, start + most)
        if not at:
            break
        yield text[start : at.start()]
        start = at.start()
    yield text[start:]


class Encoder:
    """Ids of texts as bytes (four a token, low byte first). Words seen before are remembered, up to a bound."""

    def __init__(self, path: str, most_known: int):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # for runs of letters that are in lower case and composed already, and one word each
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.most_known = most_known
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}

    def learn(self, new: set[str]) -> None:
        """Adds the ids of ``new`` words to what is known."""
        found = [*map(PLAIN.fullmatch, new)]
        split = [m and m.groups() for m in found]
        runs = {g[1] for g in split if g}
        marks = {g[k] for g in split if g for k in (0, 2)}
        others = [w for w, g in zip(new, split) if not g]
        for tokenizer, missing in ((self.letters, runs.difference(self.parts)), (self.tokenizer, marks.difference(self.parts).union(others))):
            missing = [*missing]
            for word, e in zip(missing, tokenizer.encode_batch_fast(missing, add_special_tokens=False)):
                self.parts[word] = array("I", e.ids).tobytes()
        parts, words = self.parts, self.words
        for w, g in zip(new, split):
            words[w] = parts[g[0]] + parts[g[1]] + parts[g[2]] if g else parts[w]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        if max(len(self.words), len(self.parts)) > self.most_known:
            self.words.clear()
            self.parts = {"": b""}
        words = []
        for text in texts:
            if "<|" not in text:  # a special token is one only in its own case
                text = text.encode().lower().decode()
            words.append(WORDS.findall(text) if SEPARATORS.search(text) else text.split())
        new = set().union(*words).difference(self.words)
        self.learn(new)
        for own in words:
            yield b"".join(map(self.words.__getitem__, own))
        for w in new:
            if len(w) > 64:  # rare, and large
                del self.words[w]
                self.parts.pop(w, None)


def kept_encoder(path: str, most_known: int) -> Encoder:
    """This Python worker's encoder: Spark gives a worker one task after another, and each goes on from what is known."""
    memory = sys.modules.setdefault("caelum_worker_memory", ModuleType("caelum_worker_memory")).__dict__
    key = f"{path} {most_known}"
    if key not in memory:
        memory[key] = Encoder(path, most_known)
    return memory[key]


def pieces(docs: DataFrame, model: str, limit: int, end: int, text: str, most_known: int, chars: int = 1 << 20) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: the ids of every text and ``end``, cut every ``limit`` ids."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import gc

        gc.disable()  # nothing here is cyclic, and collections would walk all known words again and again
        encoder = kept_encoder(model, most_known)
        last, size = np.array([end], "<u4").tobytes(), 4 * limit
        for batch in rows_of(batches):
            rows: list[tuple] = []
            ids = batch.column(0).to_pylist()
            held: list[tuple[int, str, bool]] = []  # row, slice, whether it is the row's last
            left, start = b"", 0

            def flush(held=held, rows=rows, ids=ids):
                nonlocal left, start
                for (row, _, ends), found in zip(held, encoder.encode([s for _, s, _ in held])):
                    left = left + found + (last if ends else b"")
                    whole = len(left) if ends else len(left) // size * size
                    for k in range(0, whole, size):
                        piece = left[k : min(k + size, whole)]
                        rows.append((ids[row], start // limit, start, len(piece) // 4, zlib.crc32(piece)))
                        start += len(piece) // 4
                    left, start = (b"", 0) if ends else (left[whole:], start)
                held.clear()

            waiting = 0
            for row, value in enumerate(batch.column(1)):
                *first, final = slices_of(value.as_py() or "", chars)
                for s, ends in [*((s, False) for s in first), (final, True)]:
                    held.append((row, s, ends))
                    waiting += len(s)
                    if waiting >= 2 * chars:
                        flush()
                        waiting = 0
            flush()
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])
        gc.enable()

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(cut_up, "doc_id long, piece int, start long, length long, ids_crc32 long")


# ------------------------------------------------------------------ packing of a block


def best_fit(lengths: np.ndarray, limit: int) -> np.ndarray:
    """The bin of each item: longest first, into the bin that it leaves the least room in."""
    home = np.zeros(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms = 0  # bit r: some bin has room r
    bins = 0
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b, bins = limit, bins, bins + 1
        home[i] = b
        with_room[room - n].append(b)
        rooms |= 1 << (room - n)
    return home


class Search:
    """Exchanges between underfull bins, each of which makes the sum of squared fills greater, until bins are empty.

    The emptiest bin gives: it moves an item to another bin, or swaps one or two of its items for one of the other's, or one for
    two of the other's, so that the other, which is at least as full, gains as much as its room allows. Each exchange moves
    fill from the less to the more full, so the sum of squares grows and the search ends; a bin that has given all is gone.
    """

    def __init__(self, lengths: np.ndarray, home: np.ndarray, limit: int):
        self.size, self.home, self.limit = lengths, home, limit
        self.items: dict[int, list[int]] = {}
        for i, b in enumerate(home.tolist()):
            self.items.setdefault(b, []).append(i)
        self.room = np.full(int(home.max(initial=-1)) + 1, 0, np.int64)
        for b, own in self.items.items():
            self.room[b] = limit - int(lengths[own].sum())

    def sums(self, bin_: int) -> tuple[np.ndarray, np.ndarray]:
        """The lengths of a bin's items, and of its pairs of items."""
        own, n = np.unique(self.size[self.items[bin_]], return_counts=True)
        pairs = np.add.outer(own, own)
        return own, pairs[~np.diag(n < 2)]

    def offer(self, giver: int) -> np.ndarray:
        """For each length up to twice the limit the longest one or two items of ``giver`` that are no longer."""
        sums = np.zeros(2 * self.limit + 1, np.int64)
        for found in self.sums(giver):
            sums[found] = found
        return np.maximum.accumulate(sums)

    def find(self, bin_: int, total: int, count: int) -> list[int] | None:
        """``count`` items of a bin that are ``total`` long together."""
        at: dict[int, int] = {}
        for i in self.items[bin_]:
            n = int(self.size[i])
            if count == 1 and n == total:
                return [i]
            if count == 2 and total - n in at:
                return [at[total - n], i]
            at.setdefault(n, i)
        return None

    def shift(self, items: list[int], source: int, target: int) -> None:
        for i in items:
            self.items[source].remove(i)
            self.items[target].append(i)
            self.home[i] = target
        total = int(self.size[items].sum())
        self.room[source] += total
        self.room[target] -= total

    def give(self, giver: int, taker: int, offer: np.ndarray) -> bool:
        """The exchange after which ``taker`` has the least room; False if there is none."""
        room = int(self.room[taker])
        ones, twos = self.sums(taker)
        back = np.append(ones, 0)
        gain = offer[back + room] - back
        k = int(gain.argmax())
        best, returned, count = int(gain[k]), int(back[k]), int(back[k] > 0)
        if best < room and len(twos):  # two of the taker's for one of the giver's
            given, _ = self.sums(giver)
            twos = np.unique(twos)
            pair = twos[np.searchsorted(twos, given - room).clip(max=len(twos) - 1)]
            gain = np.where(given - pair <= room, given - pair, 0)
            k = int(gain.argmax())
            if gain[k] > best:
                best, returned, count = int(gain[k]), int(pair[k]), 2
        if best <= 0:
            return False
        total = best + returned
        own = self.find(giver, total, 1) or (self.find(giver, total, 2) if count < 2 else None)
        other = self.find(taker, returned, count) if count else []
        if own is None or other is None:
            return False
        self.shift(own, giver, taker)
        self.shift(other, taker, giver)
        return True

    def run(self, sweeps: int = 4) -> np.ndarray:
        # each item of more than half a bin needs its own: with no other bins none can go, here or beside any other block
        if (self.size * 2 > self.limit).sum() == len(self.items):
            return self.home
        for _ in range(sweeps):
            changed = False
            for giver in sorted((b for b in self.items if self.items[b] and self.room[b]), key=lambda b: (-self.room[b], b)):
                moved = True
                while moved and self.items[giver]:
                    moved = False
                    offer = self.offer(giver)
                    # takers that gain by a move or by giving one item back
                    with_room = np.flatnonzero((self.room > 0) & (self.room < self.limit))
                    gains = np.zeros(len(self.room), bool)
                    gains[with_room] = offer[self.room[with_room]] > 0
                    gains[self.home] |= offer[self.size + self.room[self.home]] > self.size
                    takers = [b for b in with_room[gains[with_room]].tolist() if b != giver and self.room[b] <= self.room[giver]]
                    for taker in sorted(takers, key=lambda b: self.room[b]):
                        if self.room[taker] > self.room[giver]:
                            break
                        if self.give(giver, taker, offer):
                            moved = changed = True
                            if not self.items[giver]:
                                break
                            offer = self.offer(giver)
            if not changed:
                break
        return self.home


# ------------------------------------------------------------------ packing of all


def pack(
    docs: DataFrame,
    model: str | None = None,
    limit: int = 4096,
    end: int = 1,
    text: str = "text",
    block_rows: int = 16_384,
    sweeps: int = 4,
    most_known: int = 1_000_000,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: where each piece of each document's ids stands.

    ``model`` is a tokenizer file that every executor can read. A document is the ids of its whole text and ``end``; only one of
    more than ``limit`` ids is cut, every ``limit`` ids. Null and empty texts are the one id ``end``; a null doc_id stays null;
    repeated rows are packed each; an empty table gives no rows; other columns are left out. Pieces of ``limit`` ids are
    sequences of their own.

    Pieces are dealt evenly into blocks of about ``block_rows``, each packed in one task: best fit, longest first, then the
    search for exchanges. Sequences that are not full after it are dealt into blocks again, whole, and searched, as long as there
    is more than one block and a round leaves at most half of the pieces open that it began with. So what is lost at the edge
    of blocks is made good, and a task never holds more than a block. Rounds are written tables.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, open boolean"
    names = [c.split()[0] for c in schema.split(", ")]

    def place(block: pd.DataFrame) -> pd.DataFrame:
        first = block["sequence_id"].isna().all()
        lengths = block["length"].to_numpy()
        home = best_fit(lengths, limit) if first else np.unique(block["sequence_id"], return_inverse=True)[1]
        search = Search(lengths, home, limit)
        bins = search.run(sweeps)
        block = block.assign(_bin=bins, open=search.room[bins] > 0).sort_values(["_bin", "_row"])
        group = block.groupby("_bin")
        return block.assign(sequence_id=group["_row"].transform("min"), offset=group["length"].cumsum() - block["length"])[[*names, "_row"]]

    path = model or public_tokenizers.path("word_bpe_49k.json")
    # a number of each row, written, so that equal rows spread over blocks and a rerun task finds the same ones
    rows = cut(pieces(docs, path, limit, end, text, most_known).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    whole = F.col("length") == limit
    done = rows.where(whole).select(*names[:5], F.col("_row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    todo = rows.where(~whole).withColumn("sequence_id", F.lit(None).cast("long"))
    left = todo.count()
    while left:
        blocks = -(-left // block_rows)
        key = F.pmod(F.xxhash64(F.coalesce("sequence_id", "_row"), F.lit(left)), F.lit(blocks))
        placed = todo.select(*names[:6], "_row").groupBy(key.alias("_block")).applyInPandas(place, schema + ", _row long")
        placed = cut(placed, "packed")
        open_ = placed.where("open")
        still = open_.count() if blocks > 1 else 0
        again = 0 < still <= left // 2
        done = done.union((placed.where("not open") if again else placed).select(*names[:7]))
        todo, left = open_, still if again else 0
    return done


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
