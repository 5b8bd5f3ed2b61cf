"""Embedding whitening by an incremental eigendecomposition.

Every task keeps the spectrum (eigenvalues and all eigenvectors) of the scatter matrix of the rows it has seen and applies one
centred rank-one update a row: the new eigenvalues are the roots of the secular equation, after deflation, and the new
eigenvectors follow from them. Spectra of tasks are combined, sixteen at a time in a tree, by updating one with the
scaled eigenvectors of the next. The basis that comes out is refined by a Rayleigh-Ritz step whose projected
covariance is summed over all tasks. Only states of one spectrum (dimensions squared) travel or reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.sizing import materialize
from .common import batch_of

#: The integers of the contract: x = floor(SCALE * c) + ORIGIN. Components beyond LIMIT / SCALE are taken as that bound.
SCALE, ORIGIN, LIMIT = 64, 1_000_000, 1 << 52
#: Rows that one task's chain of updates takes, and spectra that one task combines.
CHAIN_ROWS, FAN_IN = 4096, 16
EPS = float(np.finfo(np.float64).eps)


def _deflated_groups(lam: np.ndarray, u: np.ndarray, z: np.ndarray, tol: float) -> None:
    """Turn each run of equal eigenvalues so that only its last vector has a share of the update (in place)."""
    ends = np.flatnonzero(np.append(np.diff(lam) > tol, True))
    start = 0
    for end in ends:
        if end > start:
            w = z[start : end + 1].copy()
            norm = math.sqrt(w @ w)
            # Reflection that maps the run's share to its last vector.
            w[-1] += math.copysign(norm, w[-1])
            length = w @ w
            if length > 0:
                z[start : end + 1] = 0.0
                z[end] = -math.copysign(norm, w[-1])
                block = u[:, start : end + 1]
                block -= np.outer(block @ w, w * (2.0 / length))
        start = end + 1


def secular_roots(lam: np.ndarray, z2: np.ndarray) -> np.ndarray:
    """Differences lam[j] - root[i] (row i, column j) for the roots of 1 + sum(z2 / (lam - root)) = 0.

    ``lam`` rises strictly and ``z2`` is positive. Each root is sought from its nearer pole by rational
    interpolation, bisected where that leaves the bracket, so the differences keep their relative accuracy.
    """
    k = len(lam)
    upper = np.append(lam[1:], lam[-1] + z2.sum())
    gap = upper - lam
    half = gap / 2
    at = 1.0 + (z2 / (lam - (lam + half)[:, None])).sum(1)
    right = at < 0
    right[-1] = False
    origin = np.where(right, upper, lam)
    away = lam - origin[:, None]
    # The two poles that enclose each root, seen from its origin.
    own, following = lam - origin, upper - origin
    low, high = np.where(right, -half, 0.0), np.where(right, 0.0, half)
    low[-1], high[-1] = 0.0, gap[-1]
    tau = np.where(right, -half / 2, half / 2)
    below = np.tri(k, dtype=bool)
    for _ in range(80):
        diff = away - tau[:, None]
        share = z2 / diff
        f = 1.0 + share.sum(1)
        slope = share / diff
        done = np.abs(f) <= 4 * EPS * k * (1.0 + np.abs(share).sum(1))
        if done.all():
            break
        low, high = np.where(f < 0, tau, low), np.where(f < 0, high, tau)
        left = (slope * below).sum(1)
        rest = slope.sum(1) - left
        d0, d1 = own - tau, following - tau
        c = f - d0 * left - d1 * rest
        a = (d0 + d1) * f - d0 * d1 * (left + rest)
        b = d0 * d1 * f
        with np.errstate(all="ignore"):
            disc = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - disc) / (2 * c), 2 * b / (a + disc))
        new = tau + step
        inside = (new > low) & (new < high)
        new = np.where(inside, new, (low + high) / 2)
        stuck = done | (new == tau) | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        if stuck.all():
            break
        tau = np.where(stuck, tau, new)
    return away - tau[:, None]


@dataclass
class Spectrum:
    """Rows seen, their mean, and the eigenvalues (rising) and eigenvectors (columns) of their scatter matrix."""

    n: int
    mean: np.ndarray
    lam: np.ndarray
    u: np.ndarray

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, np.zeros(width), np.zeros(width), np.eye(width))

    def rank_one(self, rho: float, v: np.ndarray) -> None:
        """Add rho * v v' to the scatter matrix."""
        z = v @ self.u
        norm2 = float(z @ z)
        weight = rho * norm2
        if not weight > 0:
            return
        z /= math.sqrt(norm2)
        lam, u = self.lam, self.u
        tol = 8 * EPS * max(float(lam[-1]), weight)
        if (lam[1:] - lam[:-1] <= tol).any():
            _deflated_groups(lam, u, z, tol)
        live = np.abs(z) * weight > tol
        if not live.any():
            return
        whole = live.all()
        poles, zl = (lam, z) if whole else (lam[live], z[live])
        diff = secular_roots(poles, weight * zl * zl)
        # The update vector for which these roots are exact; vectors made from it are orthogonal to working accuracy.
        k = len(poles)
        between = np.abs(poles - poles[:, None])
        between[np.arange(k), np.arange(k)] = 1.0
        fitted = np.exp(0.5 * (np.log(np.abs(diff)).sum(0) - np.log(between).sum(0)))
        q = np.copysign(fitted, zl) / diff
        q /= np.sqrt((q * q).sum(1))[:, None]
        # The root measured from the pole it is nearest to, so that no digits cancel.
        nearest = np.abs(diff).argmin(1)
        roots = poles[nearest] - diff[np.arange(k), nearest]
        if whole:
            self.lam, self.u = roots, u @ q.T
            return
        lam = lam.copy()
        lam[live] = roots
        u[:, live] = u[:, live] @ q.T
        order = np.argsort(lam, kind="stable")
        self.lam, self.u = lam[order], u[:, order]

    def add_row(self, x: np.ndarray) -> None:
        """One more row: a rank-one update with its distance from the mean before it."""
        away = x - self.mean
        if self.n:
            self.rank_one(self.n / (self.n + 1), away)
        self.n += 1
        self.mean = self.mean + away / self.n

    def add(self, other: Spectrum) -> None:
        """The rows of another spectrum: one update for each of its eigenvectors and one for the distance of the means."""
        if not other.n:
            return
        for value, vector in zip(other.lam, other.u.T):
            if value > 0:
                self.rank_one(float(value), vector)
        total = self.n + other.n
        away = other.mean - self.mean
        if self.n:
            self.rank_one(self.n * other.n / total, away)
        self.mean = self.mean + away * (other.n / total)
        self.n = total


@dataclass(frozen=True)
class Whitening:
    """Fitted model of vectors of one length: rows and sums of the fit list, components as columns, their eigenvalues."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = float("nan")

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n * x - S as exact integers: int64 where they and their squares' sum fit, Python's otherwise."""
        width = max(1, x.shape[1])
        far = self.n * float(np.abs(x).max(initial=0)) + float(max(map(abs, self.sums), default=0))
        sums = np.array(self.sums, object)
        if far * far * width < 2.0**62:
            return x * self.n - sums.astype(np.int64)
        return x.astype(object) * self.n - sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        return (self.numerators(x) / self.n).astype(np.float64)

    def transform(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.eigenvalues))


def lattice(vector: Column) -> Column:
    """floor(64 * c) of every component as a long; the origin is left out, since nothing depends on it but size."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))))


def usable(vector: Column) -> Column:
    """True for vectors that are not NULL and hold neither a NULL nor a non-finite component."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def matrices(batches: Iterator[pa.RecordBatch], column: str = "x") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of every length of each batch, with their integers as a matrix; empty vectors have no component and none is given."""
    for b in batches:
        sizes = b.column(column).value_lengths().to_numpy(zero_copy_only=False)
        for width in np.unique(sizes[sizes > 0]):
            part = b if (sizes == width).all() else b.filter(pa.array(sizes == width))
            yield part, np.asarray(part.column(column).flatten()).reshape(-1, width)


STATE = "width int, id long, n long, sums array<string>, mean array<double>, lam array<double>, u array<double>"
STATE_SCHEMA = pa.schema([("width", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.string())), ("mean", pa.list_(pa.float64())), ("lam", pa.list_(pa.float64())), ("u", pa.list_(pa.float64()))])


def _state_row(width: int, id: int, s: Spectrum, sums: list[int]) -> dict:
    return {"width": width, "id": id, "n": s.n, "sums": [str(v) for v in sums], "mean": s.mean.tolist(), "lam": s.lam.tolist(), "u": s.u.ravel().tolist()}


def _read_state(row: dict) -> tuple[Spectrum, list[int]]:
    width = row["width"]
    return Spectrum(row["n"], np.array(row["mean"]), np.array(row["lam"]), np.array(row["u"]).reshape(width, width)), [int(v) for v in row["sums"]]


def spectra(rows: DataFrame) -> DataFrame:
    """One state a task and vector length over the integer vectors ``x`` of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, tuple[Spectrum, list[int]]] = {}
        for _, x in matrices(batches):
            width = x.shape[1]
            state, sums = own.setdefault(width, (Spectrum.empty(width), [0] * width))
            for row in x.astype(np.float64):
                state.add_row(row)
            small = float(np.abs(x).max()) * len(x) < 2.0**62
            total = x.sum(0) if small else x.astype(object).sum(0)
            sums[:] = [a + int(b) for a, b in zip(sums, total)]
        if own:
            yield pa.RecordBatch.from_pylist([_state_row(w, 0, s, t) for w, (s, t) in own.items()], schema=STATE_SCHEMA)

    states = rows.select("x").mapInArrow(run, STATE)
    return states.withColumn("id", F.monotonically_increasing_id())


def combined(states: DataFrame) -> DataFrame:
    """One state for each vector length: groups of ``FAN_IN`` states are combined until one is left."""

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["id"])
        state, sums = _read_state(rows[0])
        for r in rows[1:]:
            other, more = _read_state(r)
            state.add(other)
            sums = [a + b for a, b in zip(sums, more)]
        return pa.Table.from_pylist([_state_row(rows[0]["width"], rows[0]["group"], state, sums)], schema=STATE_SCHEMA)

    while True:
        states = materialize(states, "spectra")
        most = states.groupBy("width").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return states
        # Groups by a hash of the written ids: about ``FAN_IN`` states each, and one group at the end.
        group = F.pmod(F.xxhash64("id"), F.lit(math.ceil(most / FAN_IN)))
        states = states.withColumn("group", group).groupBy("width", "group").applyInArrow(merge, STATE)


def _summed(rows: DataFrame, models: dict[int, Whitening], of: str) -> dict[int, np.ndarray]:
    """Per vector length, the sum over all rows of y y' for their projections y ('ritz': on the basis, 'white': whitened)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for _, x in matrices(batches):
            model = models[x.shape[1]]
            y = model.centred(x) @ model.components if of == "ritz" else model.transform(x)
            own[x.shape[1]] = own.get(x.shape[1], 0) + y.T @ y
        for width, total in own.items():
            yield pa.RecordBatch.from_pydict({"width": pa.array([width], pa.int32()), "part": pa.array([total.ravel().tolist()], pa.list_(pa.float64()))})

    parts = rows.select("x").mapInArrow(run, "width int, part array<double>")
    sums = parts.select("width", F.posexplode("part").alias("at", "v")).groupBy("width", "at").agg(F.sum("v").alias("v"))
    found: dict[int, list] = {}
    for r in sums.collect():  # dimensions squared numbers a length, whatever the number of rows
        found.setdefault(r["width"], []).append((r["at"], r["v"]))
    return {w: np.array([v for _, v in sorted(own)]).reshape(math.isqrt(len(own)), -1) for w, own in found.items()}


def fit(rows: DataFrame, most_components: int = 16) -> dict[int, Whitening]:
    """Whitening model of each vector length in ``rows`` (column ``x``: integer vectors, each of them once)."""
    total = rows.count()
    if not total:
        return {}
    chains = rows.repartition(max(1, math.ceil(total / CHAIN_ROWS)), "x")
    models = {}
    for r in combined(spectra(chains)).collect():  # one row a vector length
        state, sums = _read_state(r.asDict())
        basis = np.linalg.qr(state.u[:, ::-1])[0]
        models[r["width"]] = Whitening(state.n, tuple(sums), basis, state.lam[::-1], 0.0)
    for width, h in _summed(rows, models, "ritz").items():
        rough = models[width]
        h /= rough.n
        value, turn = np.linalg.eigh((h + h.T) / 2)
        value, vectors = value[::-1], rough.components @ turn[:, ::-1]
        trace = float(np.trace(h))
        keep = np.flatnonzero(value > max(trace, 0.0) * width * EPS * 16)[:most_components]
        chosen = vectors[:, keep]
        chosen = chosen / np.sqrt((chosen * chosen).sum(0))
        chosen = chosen * np.where(chosen[np.abs(chosen).argmax(0), np.arange(len(keep))] < 0, -1.0, 1.0) if len(keep) else chosen
        models[width] = Whitening(rough.n, rough.sums, chosen, value[keep], trace)
    some = {w: m for w, m in models.items() if len(m.eigenvalues)}
    for width, h in _summed(rows, {**models, **some}, "white").items() if some else ():
        m = models[width]
        if len(m.eigenvalues):
            models[width] = Whitening(m.n, m.sums, m.components, m.eigenvalues, m.trace, float(np.abs(h / m.n - np.eye(len(h))).max()))
    return models


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
OUT_SCHEMA = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 16) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component.

    Left out are rows whose vector is NULL or holds a NULL or non-finite component. Repeated rows stay repeated, rows with a
    NULL id are kept; equal vectors count once in the fit. Vectors of each length have a model of their own. A component whose
    eigenvalue is zero to working accuracy (constant data, a single row) has no whitened value and no rows. ``deviation`` is
    NULL where it exceeds a long; components beyond 2**46 count as 2**46. An empty table gives an empty result.
    Only the key and the vector are read. A task's chain costs dimensions cubed a row.
    """
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(usable(F.col("v")))
    rows = rows.select("vec_id", lattice(F.col("v")).alias("x"))
    models = fit(materialize(rows.select("x").distinct(), "fit_list"), components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in matrices(batches):
            m = models[x.shape[1]]
            k = len(m.eigenvalues)
            if not k:
                continue
            far = m.numerators(x)
            squares = (far * far).sum(1)
            deviation = pa.array([int(v) if v < 1 << 63 else None for v in squares], pa.int64()) if far.dtype == object else pa.array(squares)
            count = len(x)
            yield batch_of(
                OUT_SCHEMA,
                vec_id=b.column("vec_id").take(pa.array(np.repeat(np.arange(count), k))),
                component=np.tile(np.arange(1, k + 1, dtype=np.int32), count),
                n=np.full(count * k, m.n),
                deviation=deviation.take(pa.array(np.repeat(np.arange(count), k))),
                whitened=m.transform(x).ravel(),
                explained=np.tile(m.eigenvalues / m.trace, count),
                identity_error=np.full(count * k, m.identity_error),
            )

    return rows.mapInArrow(run, OUT)
