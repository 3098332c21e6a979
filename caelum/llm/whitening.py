"""Whitening of embeddings on their leading components: an exact covariance, its spectrum sliced by inertia counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caelum.llm.common import cut, rows_of, table

ALPHA = (1 + 17**0.5) / 8  # of Bunch and Kaufman: bounds the growth of what is left after a pivot
LIMB = 40  # bits of the pieces in which whole numbers of any size are added up
EPS = 2.0**-52
MOST_LONG = (1 << 63) - 1


# ------------------------------------------------------------------ eigenvectors


def above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of symmetric ``a`` are greater than ``shift``: the positive part of D in LDLᵀ = a - shift I.

    Pivots of order one or two are chosen as by Bunch and Kaufman. One of order two always has an eigenvalue of each sign.
    """
    a = a - shift * np.eye(len(a))
    found = 0
    while len(a):
        size = 1
        if len(a) > 1:
            r = 1 + int(np.abs(a[1:, 0]).argmax())
            side = abs(a[r, 0])
            if side > 0 and abs(a[0, 0]) < ALPHA * side:
                column = np.abs(a[:, r])
                column[r] = 0
                if abs(a[0, 0]) * column.max() < ALPHA * side * side:
                    size, place = (1, 0) if abs(a[r, r]) >= ALPHA * column.max() else (2, 1)
                    if place != r:
                        a[[place, r]] = a[[r, place]]
                        a[:, [place, r]] = a[:, [r, place]]
        pivot, rest = a[:size, :size], a[size:, :size]
        if size == 2:
            found += 1
            a = a[2:, 2:] - rest @ np.linalg.solve(pivot, rest.T)
        else:
            found += int(pivot[0, 0] > 0)
            a = a[1:, 1:] - (np.outer(rest, rest) / pivot[0, 0] if pivot[0, 0] else 0)
    return found


def leading(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` greatest eigenvalues of symmetric ``a``, falling, and their unit eigenvectors as columns.

    The spectrum is sliced by inertia counts until a slice holds one eigenvalue, which also numbers it. Inverse iteration
    from the slice's middle and Rayleigh quotient iteration give its vector. A pair is taken if it lies in its slice and
    counts at both sides of the quotient, a residual away, certify its number; else the slice is halved. A slice as narrow as
    rounding is one multiple eigenvalue: any orthonormal vectors of its space do. The sign makes each largest entry positive.
    """
    d = len(a)
    most = min(most, d)
    if not a.any():
        return np.zeros(most), np.eye(d)[:, :most]
    radius = np.abs(a).sum(1) - np.abs(a.diagonal())
    low, high = (a.diagonal() - radius).min(), (a.diagonal() + radius).max()
    tiny = EPS * d * np.abs(a).sum(1).max()
    values, vectors = [], np.zeros((d, 0))

    def polished(x: np.ndarray, shift: float) -> np.ndarray:
        """One step of inverse iteration, kept orthogonal to what was found."""
        for nudge in (0.0, tiny):
            try:
                x = np.linalg.solve(a - (shift + nudge) * np.eye(d), x)
                break
            except np.linalg.LinAlgError:
                continue
        for _ in range(2):
            x = x / np.linalg.norm(x)
            x = x - vectors @ (vectors.T @ x)
        return x / np.linalg.norm(x)

    def pair(lo: float, hi: float) -> tuple[float, np.ndarray, float]:
        """Quotient, vector and residual of the best step from the slice's middle."""
        x = np.random.default_rng(len(values)).standard_normal(d)
        for _ in range(3):
            x = polished(x, (lo + hi) / 2)
        best = None
        for _ in range(12):
            q = float(x @ a @ x)
            residual = float(np.linalg.norm(a @ x - q * x))
            if best is not None and residual >= best[2]:
                break
            best = (q, x, residual)
            x = polished(x, q)
        return best

    slices = [(low - tiny, d, high + tiny, 0)]
    while slices and len(values) < most:
        lo, n_lo, hi, n_hi = slices.pop()
        if n_lo == n_hi:
            continue
        multiple = hi - lo <= 8 * tiny
        if multiple or n_lo - n_hi == 1:
            for number in range(n_hi + 1, min(n_lo, most) + 1):
                q, x, residual = pair(lo, hi)
                off = residual + tiny
                if not multiple and not (lo < q < hi and above(a, q - off) >= number > above(a, q + off)):
                    break
                values.append(q)
                vectors = np.column_stack([vectors, x * np.sign(x[np.abs(x).argmax()])])
            else:
                continue
        middle = (lo + hi) / 2
        n = above(a, middle)
        slices += [(lo, n_lo, middle, n), (middle, n, hi, n_hi)]
    return np.array(values), vectors


# ------------------------------------------------------------------ sums over all vectors


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """``value`` as pieces of 40 bits and its sign, so that sums of pieces fit a long: (place, piece)."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield place, sign * (value & ((1 << LIMB) - 1))
        value >>= LIMB
        place += 1


def matrices(batch: pa.RecordBatch, scale: int, shift: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, whole numbers) of the batch's usable vectors, one matrix for each length.

    The second column holds lists of doubles. Null and empty lists and those with a null or non-finite entry are left out.
    """
    lists = batch.column(1)
    ends = lists.offsets.to_numpy()
    entries = lists.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)  # null entries become NaN
    wrong = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    length = np.diff(ends)
    usable = np.asarray(lists.is_valid()) & (length > 0) & (wrong[ends[1:]] == wrong[ends[:-1]])
    for d in np.unique(length[usable]):
        rows = np.flatnonzero(usable & (length == d))
        whole = np.floor(scale * entries[ends[rows][:, None] + np.arange(d)])
        yield int(d), rows, np.clip(whole, -(2.0**62), 2.0**62).astype(np.int64) + shift


def gram(y: np.ndarray) -> np.ndarray:
    """yᵀy of whole numbers, exact: in doubles by blocks where no sum exceeds their 53 bits, else in Python's integers."""
    most = int(np.abs(y).max(initial=0))
    if most < 1 << 24:
        step = max(1, (1 << 53) // max(most * most, 1))
        parts = (y[k : k + step].astype(np.float64) for k in range(0, len(y), step))
        return sum(((p.T @ p).astype(np.int64).astype(object) for p in parts), np.zeros((y.shape[1],) * 2, object))
    y = y.astype(object)
    return y.T @ y


def added(vectors: DataFrame, scale: int, shift: int, middle: dict[int, np.ndarray] | None) -> dict[int, tuple[int, np.ndarray]]:
    """By vector length: the number of vectors and, without ``middle``, their sums, else the products' sums around it, exact.

    Each task adds up its vectors and sends one row a sum and limb, which Spark adds up; the driver gets no more rows than the
    square of the vector length.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in rows_of(batches):
            for d, rows, x in matrices(batch, scale, shift):
                own = held.setdefault(d, [0, 0])
                own[0] += len(rows)
                # halves, so that no sum of a batch leaves 64 bits
                own[1] = own[1] + (((x >> 32).sum(0).astype(object) << 32) + (x & 0xFFFFFFFF).sum(0).astype(object) if middle is None else gram(x - middle[d]))
        out = []
        for d, (n, total) in held.items():
            cells = enumerate(total) if middle is None else ((i * d + j, total[i, j]) for i in range(d) for j in range(i + 1))
            out += [(d, -1, 0, n)] + [(d, cell, place, piece) for cell, value in cells for place, piece in limbs(int(value))]
        if out:
            names = ["dim", "cell", "place", "piece"]
            types = [pa.int32(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    rows = vectors.mapInArrow(sums, "dim int, cell long, place int, piece long").groupBy("dim", "cell", "place").agg(F.sum("piece").alias("piece")).collect()
    result: dict[int, tuple[int, np.ndarray]] = {}
    for r in rows:
        if r["cell"] < 0:
            size = r["dim"] if middle is None else r["dim"] ** 2
            result[r["dim"]] = (r["piece"], np.zeros(size, object))
    for r in rows:
        if r["cell"] >= 0:
            result[r["dim"]][1][r["cell"]] += r["piece"] << (LIMB * r["place"])
    return result


def fit(vectors: DataFrame, most: int, scale: int, shift: int) -> dict[int, dict]:
    """By vector length: n, sums and the leading components of the covariance, from all vectors.

    Products are taken after subtracting the whole part of each mean; what the fraction changes is put right in whole numbers,
    so the covariance is exact but for one rounding of each entry.
    """
    sums = added(vectors, scale, shift, None)
    middle = {d: np.array([int(s) // n for s in total], np.int64) for d, (n, total) in sums.items()}
    products = added(vectors, scale, shift, middle)
    models = {}
    for d, (n, total) in sums.items():
        rest = [int(s) - n * int(m) for s, m in zip(total, middle[d])]
        cov = np.zeros((d, d))
        for i in range(d):
            for j in range(i + 1):
                cov[i, j] = cov[j, i] = (n * products[d][1][i * d + j] - rest[i] * rest[j]) / (n * n)
        values, components = leading(cov, most)
        trace = float(cov.trace())
        values = np.where(values > EPS * d * max(values[0], 0), values, 0.0)
        models[d] = {"n": n, "middle": middle[d], "rest": np.array(rest, np.int64), "values": values, "components": components, "trace": trace}
    return models


# ------------------------------------------------------------------ whitening


def squared(z: np.ndarray) -> list[int | None]:
    """Sums of squares of rows of whole numbers, exact; null where they do not fit a long."""
    return [s if s <= MOST_LONG else None for s in map(int, (z.astype(object) ** 2).sum(1))]


def whitened_rows(vectors: DataFrame, models: dict[int, dict], scale: int, shift: int) -> DataFrame:
    """``vec_id, dim, deviation, whitened`` (an array over components; null where the eigenvalue is zero) of usable vectors."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            for d, rows, x in matrices(batch, scale, shift):
                m = models[d]
                n, y = m["n"], x - m["middle"]
                reach = int(np.abs(y).max()) * n + n  # z = n x - S, entry by entry
                if reach**2 * d <= MOST_LONG:
                    deviation = ((n * y - m["rest"]) ** 2).sum(1)
                else:
                    deviation = squared(n * y.astype(object) - m["rest"].astype(object))
                values = m["values"]
                with np.errstate(divide="ignore", invalid="ignore"):
                    w = (y - m["rest"] / n) @ m["components"] / np.sqrt(values)
                flat = pa.array(w.ravel(), mask=np.tile(values == 0, len(rows)))
                lists = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * len(values), flat)
                ids = batch.column(0).take(pa.array(rows))
                columns = [ids, pa.array(np.full(len(rows), d, np.int32)), pa.array(deviation, pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "dim", "deviation", "whitened"])

    return vectors.mapInArrow(project, "vec_id long, dim int, deviation long, whitened array<double>")


def identity_errors(rows: DataFrame, models: dict[int, dict]) -> dict[int, float | None]:
    """By vector length: the largest distance of an entry of the whitened covariance from the identity.

    Means first, then products of what is left of them. Components of eigenvalue zero take no part; null if there is no other.
    """
    k = max((len(m["values"]) for m in models.values()), default=0)
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    at = lambda i: F.get("whitened", F.lit(i))
    means = rows.groupBy("dim").agg(*[F.avg(at(i)).alias(f"m{i}") for i in range(k)]).collect() if k else []
    if not means:
        return {}
    centre = F.create_map(*[x for r in means for x in (F.lit(r["dim"]), F.array(*[F.lit(r[f"m{i}"]).cast("double") for i in range(k)]))])
    own = rows.withColumn("_m", F.element_at(centre, F.col("dim")))
    left = lambda i: at(i) - F.get("_m", F.lit(i))
    cov = own.groupBy("dim").agg(*[F.avg(left(i) * left(j)).alias(f"c{i}_{j}") for i, j in pairs]).collect()
    return {r["dim"]: max((abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if r[f"c{i}_{j}"] is not None), default=None) for r in cov}


def whiten(vectors: DataFrame, most: int = 8, scale: int = 1024, shift: int = 100_000, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable vector and leading component.

    Entries become the whole numbers floor(scale * entry) + shift; ``deviation`` is the exact sum of (n x - S)² (null if it
    exceeds a long). Vectors that are null, empty or hold a null or non-finite entry are left out; vectors of different lengths
    are fitted apart, each with its own n, and have as many components as entries if these are fewer than ``most``. Entries
    beyond 2^62 count as that. Components of eigenvalue zero (equal vectors, or fewer vectors than components) explain 0 and
    their ``whitened`` is null; ``identity_error`` is over the others. Rows of null vec_id and repeated rows count and come back
    like any; an empty table gives no rows; other columns are left out.

    Three scans: sums, products, projections. The driver holds a matrix of the vectors' length squared.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    models = fit(given, most, scale, shift)
    rows = cut(whitened_rows(given, models, scale, shift), "whitened")
    errors = identity_errors(rows, models)
    facts = [
        (d, c + 1, m["n"], float(e / m["trace"]) if m["trace"] else 0.0, errors.get(d)) for d, m in models.items() for c, e in enumerate(m["values"])
    ]
    facts = spark.createDataFrame(facts, "dim int, component int, n long, explained double, identity_error double")
    long = rows.select("vec_id", "dim", "deviation", F.posexplode("whitened").alias("component", "whitened")).withColumn("component", F.col("component") + 1)
    # one row a component and vector length, not one a vector: it is bounded by what the driver has just held
    return long.join(F.broadcast(facts), ["dim", "component"]).select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
