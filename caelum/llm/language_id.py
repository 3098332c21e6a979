"""Language identification: scripts narrow the candidates, Viterbi over per-word scores labels spans."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caelum.llm.common import rows_of, table

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
BUCKETS = 1 << 15

# First code points of Unicode's main script ranges; each range ends where the next begins.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x07C0, "Nko"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"),
    (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Cherokee"), (0x1780, "Khmer"), (0x1800, "Mongolian"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"),
    (0x3040, "Hiragana"), (0x30A0, "Katakana"), (0x3100, "Other"), (0x3130, "Hangul"), (0x3190, "Other"),
    (0x3400, "Han"), (0xA000, "Other"), (0xA720, "Latin"), (0xA800, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"),
    (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Other"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFE70, "Arabic"),
    (0xFF00, "Latin"), (0xFF66, "Katakana"), (0xFFA0, "Hangul"), (0xFFE0, "Other"), (0x20000, "Han"), (0x32000, "Other"),
]
STARTS = np.array([s for s, _ in SCRIPTS])
NAMES = sorted({name for _, name in SCRIPTS})
CODES = np.array([NAMES.index(name) for _, name in SCRIPTS])


def grams_of(words: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For n = 1, 2, 3 the buckets of all n-grams of marked words and each word's first; each word's script."""
    marked = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.flatnonzero(marked == 2)
    of = np.cumsum(marked == 2)
    out, mixed = [], np.zeros(len(marked), np.uint64)
    for n in (1, 2, 3):
        size = len(marked) - n + 1
        mixed = (mixed[:size] * np.uint64(0x100000001B3)) ^ marked[n - 1 :].astype(np.uint64)
        inside = of[n - 1 :] == of[:size]
        hashed = (mixed[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        out.append(((hashed >> np.uint64(64 - 15)).astype(np.int64), begins - (n - 1) * np.arange(len(begins))))
    return out, CODES[np.searchsorted(STARTS, marked[begins + 1], "right") - 1]


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # (buckets, languages)
    written: np.ndarray  # (scripts, languages): whether the language is a candidate

    def scores(self, words: list[str]) -> np.ndarray:
        grams, scripts = grams_of(words)
        total = sum(np.add.reduceat(self.logs[buckets], first, axis=0) for buckets, first in grams)
        allowed = self.written[scripts]
        total = np.where(allowed, total, -1e4)
        return np.where(allowed.any(1)[:, None], total - total.max(1)[:, None], 0).astype(np.float32)


def train(docs: DataFrame, bound: int, share: float) -> Model | None:
    """Counts of hashed character n-grams and scripts by language, from (doc_id, lang, text).

    A language of more than ``bound`` rows is fitted on a sample of about that many, chosen by a hash of the row, but always on
    the row of the least hash: none is lost. Sizes are read first, a number a language, and rows are chosen while they are
    scanned, so only the sample's counts move.
    """
    row = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 12)
    sizes = docs.groupBy("lang").agg(F.count("*").alias("n"), F.min(row).alias("least")).collect()
    if not sizes:
        return None
    limit = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(max(r["least"], (bound << 52) // r["n"])))])
    sample = docs.where(row <= F.element_at(limit, F.col("lang")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            words: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words.setdefault(lang, []).extend(WORD.findall(text.as_py().lower()))
            for lang, own in words.items():
                if own:
                    grams, scripts = grams_of(own)
                    n = np.bincount(np.concatenate([b for b, _ in grams]), minlength=BUCKETS)
                    n = np.concatenate([n, np.bincount(scripts, minlength=len(NAMES))])
                    at = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "slot", "n"])

    counted = sample.select("lang", "text").mapInArrow(count, "lang string, slot long, n long")
    by_lang = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).groupBy("lang")
    rows = by_lang.agg(F.collect_list(F.struct("slot", "n")).alias("counts")).orderBy("lang").collect()  # a row of at most BUCKETS + scripts numbers a language
    if not rows:
        return None
    n = np.zeros((len(rows), BUCKETS + len(NAMES)))
    for k, row in enumerate(rows):
        slots, counts = zip(*row["counts"])
        n[k, list(slots)] = counts
    grams, scripts = n[:, :BUCKETS] + 0.5, n[:, BUCKETS:]
    logs = np.log(grams / grams.sum(1, keepdims=True)).T.astype(np.float32)
    return Model([r["lang"] for r in rows], np.ascontiguousarray(logs), (scripts >= share * scripts.sum(1, keepdims=True)).T & (scripts > 0).T)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word: ``scores`` (texts, words, languages), padded; a switch costs ``penalty``."""
    texts, steps, langs = scores.shape
    value = np.zeros((texts, langs), np.float32)
    came = np.zeros((steps, texts, langs), np.int16)
    own = np.arange(langs, dtype=np.int16)
    for t in range(steps):
        best = value.argmax(1)
        switched = value.max(1, keepdims=True) - penalty
        came[t] = np.where(value >= switched, own, best[:, None])
        value = np.maximum(value, switched) + scores[:, t]  # past a text's end all scores are 0
    path = np.zeros((texts, steps), np.int16)
    state, rows = value.argmax(1), np.arange(texts)
    for t in range(steps - 1, -1, -1):
        path[:, t] = state
        state = came[t, rows, state]
    return path


def predictions(docs: DataFrame, model: Model | None, penalty: float = 12.0, chunk: int = 1 << 18) -> DataFrame:
    """(``_key``, text) as ``_key, lang_pred, score, spans``: spans hold runs of words of one language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = "_key struct<doc_id:long,held_out:boolean>, lang_pred string, score double, spans array<struct<lang:string,words:int,letters:int>>"

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known: dict[str, int] = {}
        matrix = None
        for batch in rows_of(batches):
            texts = [WORD.findall((v.as_py() or "").lower()) for v in batch.column(1)]
            out: list = [("und", 0.0, [])] * len(texts)
            rows = [k for k, words in enumerate(texts) if words] if model else []
            if len(known) > 300_000:
                known, matrix = {}, None
            new = [*dict.fromkeys(w for k in rows for w in texts[k] if w not in known)]
            if new:
                known.update(zip(new, range(len(known), len(known) + len(new))))
                matrix = np.concatenate([*([] if matrix is None else [matrix]), model.scores(new)])
            rows.sort(key=lambda k: len(texts[k]))
            while rows:
                steps = len(texts[rows[-1]])
                own = rows[-max(1, chunk // (steps * len(model.languages))) :]
                del rows[-len(own) :]
                lengths = np.array([len(texts[k]) for k in own])
                scores = np.zeros((len(own), steps, len(model.languages)), np.float32)
                for r, k in enumerate(own):
                    scores[r, : lengths[r]] = matrix[np.fromiter(map(known.__getitem__, texts[k]), np.int64, lengths[r])]
                for k, path, n in zip(own, viterbi(scores, lengths, penalty), lengths):
                    letters = np.fromiter(map(len, texts[k]), np.int64, n)
                    path = path[:n]
                    sums = np.bincount(path, letters, len(model.languages))
                    cuts = np.concatenate(([0], np.flatnonzero(path[1:] != path[:-1]) + 1, [n]))
                    total = np.concatenate(([0], np.cumsum(letters)))
                    spans = [{"lang": model.languages[path[a]], "words": int(b - a), "letters": int(total[b] - total[a])} for a, b in zip(cuts, cuts[1:])]
                    out[k] = (model.languages[sums.argmax()], float(sums.max() / sums.sum()), spans)
            lang, score, spans = zip(*out)
            kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32()), ("letters", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang), pa.array(score, pa.float64()), pa.array(spans, kind)], ["_key", "lang_pred", "score", "spans"])

    return docs.select("_key", "text").mapInArrow(label, kinds)


def identify(docs: DataFrame, bound: int = 2000, share: float = 0.01, penalty: float = 12.0) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, spans`` of every row of ``docs`` (doc_id, text, lang).

    Rows whose crc32(doc_id as text) mod 4 is 2 are held out of the fit; the others teach, if they have text and
    lang, with at most about ``bound`` rows a language. A language is a candidate for a word if at least ``share``
    of its words are in the word's script; a word in a script of no language weighs nothing. ``score`` is the share of letters in the
    spans of the predicted language. Null texts and texts without a letter, and all texts where nothing was learned, are
    ``und`` with score 0. A null doc_id is not held out and does not teach. Repeated rows are predicted alike.
    """
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = train(rows.where((rest != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text"), bound, share)
    key = F.struct("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out")).alias("_key")
    return predictions(rows.select(key, "text"), model, penalty).select("_key.*", "lang_pred", "score", "spans")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("spans")
