"""N-best segmentation over a piece lattice: forward Viterbi, then backward A-star with its scores as exact heuristic.

The vocabulary and the scores are those of a sentencepiece model file. No piece joins two characters whose pair
is in no piece, so every path passes such places: texts are cut there into units, units are solved once in
a task, and a text's best segmentations are those of its units put together.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caelum.llm.common import rows_of, table

SPACE = "▁"
NONE = -1e18
PRIME = np.uint64(0x9E3779B97F4A7C15)
Change = tuple[int, int, list[int]]


def _step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    h = (h ^ c.astype(np.uint64)) * PRIME
    return h ^ (h >> np.uint64(31))


class State:
    """A place in the lattice and how it was reached from the end of the unit: a link to the state before and the piece between.

    States are in the order of their piece lengths from the end, longer ones first. Two are compared where their ways part, which jump
    links find in logarithmic time, so a state has the same size wherever it is.
    """

    __slots__ = ("before", "jump", "depth", "length", "ids", "at", "score")

    def __init__(self, before: State | None, length: int, ids: tuple[int, ...], at: int, score: float):
        self.before, self.length, self.ids, self.at, self.score = before, length, ids, at, score
        if before is None:
            self.depth, self.jump = 0, self
        else:
            self.depth, far = before.depth + 1, before.jump
            self.jump = far.jump if before.depth - far.depth == far.depth - far.jump.depth else before

    def up(self, depth: int) -> State:
        state = self
        while state.depth > depth:
            state = state.jump if state.jump.depth >= depth else state.before
        return state

    def __lt__(self, other: State) -> bool:
        depth = min(self.depth, other.depth)
        a, b = self.up(depth), other.up(depth)
        if a is b:
            return self.depth < other.depth
        while a.before is not b.before:
            a, b = (a.jump, b.jump) if a.jump is not b.jump else (a.before, b.before)
        return a.length > b.length


class Pieces:
    """The normal pieces of a model, its byte pieces, and the score of a character that needs bytes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        own = [i for i in range(size) if not special[i] and not model.is_byte(i)]
        self.ids = {model.id_to_piece(i): i for i in own}
        self.scores = {i: float(model.get_score(i)) for i in own}
        self.arc_of = {p: (len(p), (i,), self.scores[i]) for p, i in self.ids.items()}
        self.single = frozenset(p for p in self.ids if len(p) == 1)
        self.unknown = min(s for s in self.scores.values() if s > -1e8) - 10
        self.longest = max(map(len, self.ids))
        self.raw = [b""] * size
        for b, i in self.bytes.items():
            self.raw[i] = bytes([b])
        for piece, i in self.ids.items():
            self.raw[i] = piece.replace(SPACE, " ").encode()
        self.pairs = np.zeros(1 << 22, bool)
        points = np.frombuffer("\0".join(self.ids).encode("utf-32-le"), np.uint32)
        inside = (points[:-1] > 0) & (points[1:] > 0)
        self.pairs[self.pair(points[:-1], points[1:])[inside]] = True
        prefixes = {piece[:n]: -1 for piece in self.ids for n in range(1, len(piece) + 1)} | self.ids
        hashes = self.hashes_of([*prefixes])
        order = np.argsort(hashes)
        self.hashes, self.piece = hashes[order], np.array([*prefixes.values()])[order]
        self.by_id = np.full(size + 1, NONE)
        for i, s in self.scores.items():
            self.by_id[i] = s

    @staticmethod
    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a.astype(np.uint64) << np.uint64(21) | b.astype(np.uint64)) * PRIME >> np.uint64(42)).astype(np.int64)

    @staticmethod
    def hashes_of(parts: list[str]) -> np.ndarray:
        h = np.zeros(len(parts), np.uint64)
        lengths = np.array([*map(len, parts)])
        rows = np.full((len(parts), lengths.max()), 0, np.uint32)
        rows[np.arange(rows.shape[1]) < lengths[:, None]] = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        for n in range(rows.shape[1]):
            h = np.where(n < lengths, _step(h, rows[:, n]), h)
        return h

    def units(self, text: str) -> list[str]:
        """The text, as the model sees it, in parts that no piece can join."""
        if not text:
            return []
        text = SPACE + text.replace(" ", SPACE)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        cuts = np.flatnonzero(~self.pairs[self.pair(points[:-1], points[1:])]) + 1
        cuts = [0, *cuts.tolist(), len(text)]
        return [text[a:b] for a, b in zip(cuts, cuts[1:])]

    def arcs(self, unit: str) -> list[list[tuple[int, tuple[int, ...], float]]]:
        """For each end: (length, ids, score) of the pieces that end there, longest first."""
        out: list = [[] for _ in range(len(unit) + 1)]
        for end in range(1, len(unit) + 1):
            for n in range(min(end, self.longest), 0, -1):
                arc = self.arc_of.get(unit[end - n : end])
                if arc is not None:
                    out[end].append(arc)
            if not out[end] or out[end][-1][0] > 1:
                raw = unit[end - 1].encode("utf-8", "surrogatepass")
                out[end].append((1, tuple(self.bytes[b] for b in raw), self.unknown))
        return out

    def nbest(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best (score, ids) of a unit; of equal scores, longer last pieces first."""
        arcs = self.arcs(unit)
        best = [0.0]
        for end in range(1, len(arcs)):
            best.append(max(best[end - k] + s for k, _, s in arcs[end]))
        found, todo = [], [(-best[-1], State(None, 0, (), len(unit), 0.0))]
        while todo and len(found) < n:
            state = heapq.heappop(todo)[1]
            at, score = state.at, state.score
            if not at:
                ids = []
                while state.before is not None:
                    ids += state.ids
                    state = state.before
                found.append((score, tuple(ids)))
                continue
            for k, ids, s in arcs[at]:
                heapq.heappush(todo, (-(score + s + best[at - k]), State(state, k, ids, at - k, score + s)))
        return found


def solve(pieces: Pieces, units: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Best score, distance of the second best (infinite if none) and best ids of short units of known characters.

    Forward Viterbi for all units at once, one array operation for each end and piece length.
    """
    size = max(map(len, units))
    points = np.zeros((len(units), size), np.uint32)
    lengths = np.array([*map(len, units)])
    points[np.arange(size) < lengths[:, None]] = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
    piece = np.full((min(size, pieces.longest) + 1, len(units), size), -1, np.int32)
    row, start = np.nonzero(np.arange(size) < lengths[:, None])
    h = np.zeros(len(row), np.uint64)
    for n in range(1, len(piece)):
        h = _step(h, points[row, start + n - 1])
        at = np.minimum(np.searchsorted(pieces.hashes, h), len(pieces.hashes) - 1)
        known = pieces.hashes[at] == h
        row, start, h = row[known], start[known], h[known]
        piece[n, row, start] = pieces.piece[at[known]]
        more = start + n < lengths[row]
        row, start, h = row[more], start[more], h[more]
    first, second = np.full((size + 1, len(units)), NONE), np.full((size + 1, len(units)), NONE)
    took = np.zeros((size + 1, len(units)), np.int8)
    first[0] = 0
    for end in range(1, size + 1):
        for n in range(min(end, len(piece) - 1), 0, -1):
            score = pieces.by_id[piece[n, :, end - n]]
            a, b = first[end - n] + score, second[end - n] + score
            better = a > first[end]
            took[end][better] = n
            second[end] = np.maximum(np.maximum(second[end], b), np.minimum(first[end], a))
            first[end] = np.maximum(first[end], a)
    rows, at = np.arange(len(units)), lengths.copy()
    steps = []
    while at.any():
        n = took[at, rows]
        steps.append(np.where(at > 0, piece[n, rows, at - n], -1))
        at -= n
    ids = np.array(steps[::-1], np.int32).T
    score, other = first[lengths, rows], second[lengths, rows]
    return score, np.where(other < NONE / 2, np.inf, score - other), [r[r >= 0] for r in ids]


class Segmenter:
    """Segments texts, remembering the units of a task up to a bound."""

    def __init__(self, pieces: Pieces, n: int, most: int = 400_000, short: int = 32):
        self.pieces, self.n, self.most, self.short = pieces, n, most, short
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.lists: dict[str, list] = {}
        self.score, self.gap, self.start, self.flat = np.zeros(0), np.zeros(0), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def learn(self, units: list[str]) -> None:
        if len(self.known) > self.most:
            self.clear()
        easy, hard = [], []
        for u in {*units}.difference(self.known):
            (easy if len(u) <= self.short and self.pieces.single.issuperset(u) else hard).append(u)
        easy.sort(key=len)
        score, gap, ids = [self.score], [self.gap], []
        for a in range(0, len(easy), 20_000):
            s, g, i = solve(self.pieces, easy[a : a + 20_000])
            score.append(s)
            gap.append(g)
            ids += i
        for u in hard:
            found = self.pieces.nbest(u, 2)
            score.append([found[0][0]])
            gap.append([found[0][0] - found[1][0] if len(found) > 1 else np.inf])
            ids.append(np.array(found[0][1], np.int32))
        self.known.update(zip(easy + hard, range(len(self.known), len(self.known) + len(ids))))
        self.score, self.gap = np.concatenate(score), np.concatenate(gap)
        if ids:
            self.start = np.concatenate((self.start, self.start[-1] + np.cumsum([len(i) for i in ids])))
            self.flat = np.concatenate((self.flat, *ids))

    def best(self, units: list[str]) -> tuple[np.ndarray, list[tuple[float, list[Change]]]]:
        """Ids of the best segmentation and the ``n`` best as (score, changes to these ids), the best with none."""
        if not units:
            return np.zeros(0, np.int32), [(0.0, [])]
        own = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        start, size = self.start[own], self.start[own + 1] - self.start[own]
        place = np.concatenate(([0], np.cumsum(size)))
        ids = self.flat[np.repeat(start - place[:-1], size) + np.arange(size.sum())]
        total, gap = self.score[own].sum(), self.gap[own]
        # A change of any other unit costs at least as much as each of these n - 1 changes alone.
        close = np.argsort(gap, kind="stable")[: self.n - 1]
        close = close[np.isfinite(gap[close])].tolist()
        picks: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
        for k in close:  # what is not among the n least of some units is not among those of more
            top, *others = self.list_of(units[k])
            losses = [0.0, *(top[0] - s for s, _ in others)]
            picks = heapq.nsmallest(self.n, ((loss + x, pick + (j,)) for loss, pick in picks for j, x in enumerate(losses)))
        found = []
        for loss, pick in picks:
            changed = sorted((k, j) for k, j in zip(close, pick) if j)
            found.append((total - loss, [(int(place[k]), int(size[k]), list(self.list_of(units[k])[j][1])) for k, j in changed]))
        return ids, found

    def list_of(self, unit: str) -> list[tuple[float, tuple[int, ...]]]:
        if unit not in self.lists:
            self.lists[unit] = self.pieces.nbest(unit, self.n)
        return self.lists[unit]


def changed_ids(ids: list[int], changes: list[Change]) -> list[int]:
    """The ids of another segmentation: of each (at, length, new), ``length`` ids from ``at`` on give way to ``new``."""
    out, done = [], 0
    for at, length, new in changes:
        out += ids[done:at] + new
        done = at + length
    return out + ids[done:]


def decode_ids(raw: list[bytes], ids) -> str:
    """The text of ``ids``: pieces and bytes joined, without the space that encoding puts first."""
    text = b"".join(map(raw.__getitem__, ids)).decode("utf-8", "surrogatepass")
    return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, model: str | None = None, n: int = 4, text: str = "text", all_ids: bool = False) -> DataFrame:
    """``doc_id, ids, n_tokens, scores, round_trip, changes`` of every row; with ``all_ids`` also ``nbest``, all n best ids.

    ``scores`` are those of the n best segmentations, falling, fewer if there are fewer; ``ids`` is the best one, and ``changes``
    says how each differs from it: instead of ``length`` ids from ``at`` on it has the ids given, in rising order, none for the best. A
    character that is no piece is spelt in byte pieces. ``round_trip``: decoding the ids gives the text again (false only for
    texts that hold U+2581 itself, which stands for the space). Null and empty texts have no ids and score 0.
    Repeated rows and null doc_ids are treated like others; other columns are left out.
    """
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    kinds = "doc_id long, ids array<int>, n_tokens long, scores array<double>, round_trip boolean, changes array<array<struct<at: int, length: int, ids: array<int>>>>"
    kinds += ", nbest array<array<int>>" * all_ids
    change = pa.struct([("at", pa.int32()), ("length", pa.int32()), ("ids", pa.list_(pa.int32()))])

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        segmenter = Segmenter(pieces, n)
        for batch in rows_of(batches, 1 << 21):
            texts = [v.as_py() or "" for v in batch.column(1)]
            units = [pieces.units(t) for t in texts]
            segmenter.learn([u for own in units for u in own])
            ids, scores, good, changes, nbest = [], [], [], [], []
            for t, own in zip(texts, units):
                found, best = segmenter.best(own)
                first = found.tolist()
                ids.append(found)
                scores.append([score for score, _ in best])
                good.append(decode_ids(pieces.raw, first) == t)
                changes.append([[dict(zip(("at", "length", "ids"), c)) for c in made] for _, made in best])
                if all_ids:
                    nbest.append([changed_ids(first, made) for _, made in best])
            columns = [
                batch.column(0),
                pa.array(ids, pa.list_(pa.int32())),
                pa.array([*map(len, ids)], pa.int64()),
                pa.array(scores, pa.list_(pa.float64())),
                pa.array(good),
                pa.array(changes, pa.list_(pa.list_(change))),
            ]
            if all_ids:
                columns.append(pa.array(nbest, pa.list_(pa.list_(pa.int32()))))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_tokens", "scores", "round_trip", "changes", "nbest"][: len(columns)])

    return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string").alias("text")).mapInArrow(segment, kinds)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give a null text, ids outside the vocabulary nothing."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = Pieces(path).raw
        for batch in rows_of(batches):
            texts = [
                None if v.as_py() is None else decode_ids(raw, [i for i in v.as_py() if i is not None and 0 <= i < len(raw)])
                for v in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(back, "doc_id long, text string")


def op10_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The n best scores, the digest of the best ids (decimal, comma-joined) and the others' changes to them (JSON) of every document."""
    rows = encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256")
    return rows.select("doc_id", "n_tokens", "scores", digest, F.to_json("changes").alias("changes"), "round_trip")
