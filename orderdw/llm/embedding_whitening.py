"""Whitening of embeddings by incremental eigendecomposition (operator 11).

Each partition keeps the eigenvalues and eigenvectors of the scatter of the vectors it has seen.
They change by centred rank-one updates only: the new eigenvalues are the roots of the secular
equation, the new eigenvectors follow from them (directions that an update leaves alone are deflated
first). Spectra of partitions are combined in a tree, one by successive rank-one updates with the
scaled eigenvectors of the other and with the difference of the means. What the root of the tree
spans is refined by Rayleigh-Ritz steps whose products with the covariance are sums over all
partitions, so that the final components are those of the whole covariance to double precision.

Vectors come in blocks. A block of more rows than dimensions is first condensed to the triangular
factor of its centred rows, which has the same scatter, and each row of the factor is one update:
the secular equation is then solved once per dimension and block instead of once per vector. With
``block_rows=1`` each vector is one update.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderdw.llm.common import table
from orderdw.session import cut_lineage

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
BLOCK_ROWS = 2048
RANK = 128  # directions that a spectrum keeps at most; fewer dimensions than that are all kept
FAN_IN = 16  # rows of a tree's node that are combined by one call
PASSES, TOLERANCE = 50, 1e-12
LARGEST = 2.0 ** 40  # scaled components from here on are refused: sums would not be exact
EPS = float(np.finfo(float).eps)


# -- the spectrum of a scatter matrix ---------------------------------------------------------


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of diag(d) + z z', for ascending, distinct ``d`` and ``z``
    without zeros.

    A root lies between each two neighbours of ``d`` and one beyond the last. It is sought as the
    distance from the nearer of the two, by Newton steps on the secular equation times that distance
    (which is smooth there), kept inside a shrinking bracket.
    """
    n, z2 = len(d), z * z
    total = z2.sum()
    above = np.append(d[1:], d[-1] + total)
    middle = (d + above) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        at_middle = 1 + (z2[:, None] / (d[:, None] - middle)).sum(axis=0)
    near = np.arange(n) + ((at_middle < 0) & (np.arange(n) < n - 1))
    pole = d[near]
    delta = d[:, None] - pole  # exact distances of all poles from each root's own
    low = np.where(near > np.arange(n), middle - pole, 0.0)
    high = np.where(near > np.arange(n), 0.0, middle - pole)
    high[-1], low[-1] = total, 0.0
    column = np.arange(n)
    others = np.broadcast_to(z2[:, None], (n, n)).copy()
    others[near, column] = 0.0
    own = z2[near]
    safe = delta.copy()
    safe[near, column] = 1.0
    slope = 1 + (others / safe).sum(axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        mu = own / slope
    mu = np.where((mu > low) & (mu < high), mu, (low + high) / 2)
    for _ in range(120):
        gap = delta - mu
        gap[near, column] = 1.0
        ratio = others / gap
        value = mu * (1 + ratio.sum(axis=0)) - own
        slope = 1 + (ratio * delta / gap).sum(axis=0)
        rising = np.where(mu > 0, value, -value)  # the sign of the secular function
        low, high = np.where(rising < 0, mu, low), np.where(rising > 0, mu, high)
        with np.errstate(divide="ignore", invalid="ignore"):
            new = mu - value / slope
        new = np.where(value == 0, mu, np.where((new > low) & (new < high), new, (low + high) / 2))
        moved = np.abs(new - mu)
        mu = new
        if (moved <= 2 * EPS * np.abs(mu)).all():
            break
    # The z for which these roots are exact: eigenvectors made from it are orthogonal.
    distance = mu - delta  # of each root from each pole
    below = d[None, :] - d[:, None]
    bound = np.where(column[None, :] < column[:, None], below, np.roll(below, -1, axis=1))
    bound[:, -1] = 1.0
    exact = np.copysign(np.sqrt(np.abs(np.prod(distance / bound, axis=1))), z)
    vectors = exact[:, None] / -distance
    return pole + mu, vectors / np.sqrt((vectors * vectors).sum(axis=0))


class Spectrum:
    """Number and mean of vectors, eigenvalues (ascending) and eigenvectors (columns) of their
    scatter around the mean."""

    def __init__(self, dim: int, rank: int = RANK) -> None:
        self.n, self.mean, self.rank = 0, np.zeros(dim), rank
        self.values, self.axes = np.empty(0), np.empty((dim, 0))

    def update(self, v: np.ndarray) -> None:
        """Scatter + v v'."""
        length = float(np.sqrt(v @ v))
        if length == 0.0:
            return
        z = self.axes.T @ v
        if self.axes.shape[1] < len(v):
            rest = v - self.axes @ z
            rest -= self.axes @ (self.axes.T @ rest)
            size = float(np.sqrt(rest @ rest))
            if size > 1e-12 * length:  # a new direction
                self.values = np.insert(self.values, 0, 0.0)
                self.axes = np.column_stack((rest / size, self.axes))
                z = np.insert(z, 0, size)
        self._rank_one(z)
        if len(self.values) > self.rank:
            self.values, self.axes = self.values[-self.rank:], self.axes[:, -self.rank:]

    def _rank_one(self, z: np.ndarray) -> None:
        d, axes = self.values, self.axes
        limit = 8 * EPS * max(float(np.abs(d).max()), float(z @ z))
        acts = np.abs(z) * float(np.sqrt(z @ z)) > limit  # the others keep value and vector
        at = np.flatnonzero(acts)
        close = np.flatnonzero(np.diff(d[at]) <= np.sqrt(EPS) * d[-1])
        for k in close.tolist():  # two values that cannot be told apart: turn one out of the way
            i, j = at[k], at[k + 1]
            r = float(np.hypot(z[i], z[j]))
            c, s = z[j] / r, z[i] / r
            if abs((d[j] - d[i]) * c * s) <= limit:
                axes[:, [i, j]] = axes[:, [i, j]] @ np.array([[c, s], [-s, c]])
                z[i], z[j], acts[i] = 0.0, r, False
                d[i], d[j] = d[i] * c * c + d[j] * s * s, d[i] * s * s + d[j] * c * c
        at = np.flatnonzero(acts)
        if len(at):
            at = at[np.argsort(d[at], kind="stable")]
            values, turn = secular_roots(d[at], z[at])
            d[at], axes[:, at] = values, axes[:, at] @ turn
        order = np.argsort(d, kind="stable")
        self.values, self.axes = d[order], axes[:, order]

    def combine(self, n: int, mean: np.ndarray, updates: np.ndarray) -> None:
        """The spectrum with ``n`` more vectors of that mean, whose scatter is the sum of the outer
        products of the rows of ``updates``."""
        if n:
            for row in updates:
                self.update(row)
            both = self.n + n
            away = mean - self.mean
            self.update(away * np.sqrt(self.n * n / both))
            self.mean, self.n = self.mean + away * (n / both), both

    def add_block(self, x: np.ndarray) -> None:
        mean = x.mean(axis=0)
        centred = x - mean
        if len(x) > x.shape[1]:
            centred = np.linalg.qr(centred, mode="r")
        self.combine(len(x), mean, centred)

    def add_spectrum(self, n: int, mean: np.ndarray, values: np.ndarray, axes: np.ndarray) -> None:
        self.combine(n, mean, (axes * np.sqrt(np.maximum(values, 0))).T[::-1])


# -- passes over the vectors ------------------------------------------------------------------


def valid_vectors(vectors: DataFrame) -> DataFrame:
    return vectors.select("vec_id", "embedding").filter(
        "embedding is not null and size(embedding) > 0 and forall(embedding,"
        " x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")


def _whole(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, places, x) of a batch: the integer vectors of each length."""
    lists = batch.column("embedding")
    cuts = lists.offsets.to_numpy()
    flat = np.floor(lists.values.to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(flat) and np.abs(flat[cuts[0]:cuts[-1]]).max(initial=0) >= LARGEST:
        raise ValueError("a component times 1024 is 2^40 or more: its sums would not be exact")
    dims = np.diff(cuts)
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        yield dim, at, flat[cuts[at][:, None] + np.arange(dim)].astype(np.int64) + SHIFT


SPECTRA = ("dim int, part long, n long, sums array<decimal(38,0)>, mean binary, vals binary,"
           " axes binary")


def _spectrum_row(dim: int, part: int, sums: list[int], s: Spectrum) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([dim], pa.int32()), pa.array([part], pa.int64()), pa.array([s.n], pa.int64()),
         pa.array([[Decimal(x) for x in sums]], pa.list_(pa.decimal128(38, 0))),
         *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())
           for x in (s.mean, s.values, s.axes))],
        ["dim", "part", "n", "sums", "mean", "vals", "axes"])


def _spectra(block_rows: int, rank: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        found: dict[int, tuple[list[int], Spectrum]] = {}

        def take(dim: int) -> None:
            x = np.concatenate(held.pop(dim))
            sums, spectrum = found.get(dim) or ([0] * dim, Spectrum(dim, rank))
            for lo in range(0, len(x), block_rows):
                spectrum.add_block((x[lo:lo + block_rows] - SHIFT).astype(np.float64))
            found[dim] = [a + b for a, b in zip(sums, x.sum(axis=0).tolist(), strict=True)], spectrum

        for batch in batches:
            for dim, _, x in _whole(batch):
                held.setdefault(dim, []).append(x)
                if sum(map(len, held[dim])) >= block_rows:
                    take(dim)
        for dim in list(held):
            take(dim)
        for dim, (sums, spectrum) in found.items():
            yield _spectrum_row(dim, TaskContext.get().partitionId(), sums, spectrum)
    return rows


def _in_tree(rows: DataFrame, schema: str, merge: Callable, label: str) -> list:
    """One row for each dim: ``merge(key, arrow table)`` combines up to FAN_IN neighbours, again and
    again."""
    rows = cut_lineage(rows, label)
    while (last := rows.agg(F.max("part")).first()[0] or 0) > 0:
        up = rows.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long"))
        rows = cut_lineage(up.groupBy("dim", "part").applyInArrow(merge, schema), label)
        assert rows.agg(F.max("part")).first()[0] < last
    return rows.collect()  # a row for each length of vectors


def _merged_spectra(rank: int):
    def merge(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        dim, part = (k.as_py() for k in key)
        spectrum, sums = Spectrum(dim, rank), [0] * dim
        for row in found.to_pylist():
            mean, values, axes = (np.frombuffer(row[c]) for c in ("mean", "vals", "axes"))
            spectrum.add_spectrum(row["n"], mean, values, axes.reshape(dim, -1))
            sums = [a + int(b) for a, b in zip(sums, row["sums"], strict=True)]
        return pa.Table.from_batches([_spectrum_row(dim, part, sums, spectrum)])
    return merge


@dataclass
class Fit:
    """What the vectors of one length give: their number, exact sums, and components as columns."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray = None
    trace: float = 0.0
    error: float = 0.0

    def __post_init__(self) -> None:
        # The mean as a whole number and the small rest, so that centring loses no digits.
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([(s % self.n) / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        away = x - self.whole
        left = np.array([s - self.n * w for s, w in zip(self.sums, self.whole.tolist(),
                                                        strict=True)], np.int64)
        most = self.n * (int(np.abs(away).max(initial=0)) + 1)
        if most * most * x.shape[1] >= 1 << 63:
            away, left = away.astype(object), left.astype(object)
        return ((self.n * away - left) ** 2).sum(axis=1).tolist()

    @property
    def full(self) -> np.ndarray:
        """Which components have a variance to scale by."""
        return self.values > 1e-12 * max(self.trace, 1e-300)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return (self.centred(x) @ self.axes) / np.sqrt(self.values)


SUMS = "dim int, part long, data binary"


def _sum_rows(fits, each: Callable):
    """``each(fit, x)``, an array, summed over the vectors of a partition."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _whole(batch):
                if dim in fits.value:
                    total[dim] = total.get(dim, 0) + each(fits.value[dim], x)
        for dim, data in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()),
                 pa.array([TaskContext.get().partitionId()], pa.int64()),
                 pa.array([data.tobytes()], pa.binary())], ["dim", "part", "data"])
    return rows


def _merged_sums(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x) for x in found.column("data").to_pylist()], axis=0)
    return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()),
                     "part": pa.array([key[1].as_py()], pa.int64()),
                     "data": pa.array([total.tobytes()], pa.binary())})


def _summed(rows: DataFrame, fits: dict[int, Fit], each: Callable, label: str
            ) -> dict[int, np.ndarray]:
    shared = rows.sparkSession.sparkContext.broadcast(fits)  # components x dimensions numbers
    sums = rows.mapInArrow(_sum_rows(shared, each), SUMS)
    return {r["dim"]: np.frombuffer(r["data"]) for r in _in_tree(sums, SUMS, _merged_sums, label)}


def _product(fit: Fit, x: np.ndarray) -> np.ndarray:
    """Centred scatter times axes, and the trace."""
    c = fit.centred(x)
    return np.append((c.T @ (c @ fit.axes)).ravel(), (c * c).sum())


def _second_moment(fit: Fit, x: np.ndarray) -> np.ndarray:
    z = fit.whitened(x)[:, fit.full]
    return np.append(z.sum(axis=0), (z.T @ z).ravel())


class Ritz:
    """Rayleigh-Ritz steps within a growing span: what is known of the covariance are its products
    with ``basis``."""

    def __init__(self, dim: int, components: int, keep: int) -> None:
        self.components, self.keep = components, keep
        self.basis, self.images = np.empty((dim, 0)), np.empty((dim, 0))
        self.values, self.vectors = np.empty(0), self.basis

    def step(self, axes: np.ndarray, images: np.ndarray) -> np.ndarray:
        """Takes products with new, orthonormal ``axes``; gives the directions to multiply next,
        none when the first components are eigenvectors."""
        self.basis = np.column_stack((self.basis, axes))
        self.images = np.column_stack((self.images, images))
        inner = self.basis.T @ self.images
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        self.values, turn = values[::-1], turn[:, ::-1]
        self.vectors, images = self.basis @ turn, self.images @ turn
        dim, found = self.basis.shape
        left = (images - self.vectors * self.values)[:, :min(found, 2 * self.components)]
        sizes = np.linalg.norm(left, axis=0)
        limit = TOLERANCE * max(float(self.values[0]), 1e-300)
        if found == dim or (sizes[:self.components] <= limit).all():
            return self.basis[:, :0]
        if found + left.shape[1] > max(4 * self.keep, 8 * self.components):  # start again with the best
            self.basis, self.images = self.vectors[:, :self.keep], images[:, :self.keep]
        new = left[:, sizes > 0] / sizes[sizes > 0]
        for _ in range(2):
            new = new - self.basis @ (self.basis.T @ new)
        new, lengths, _ = np.linalg.svd(new, full_matrices=False)
        new = new[:, lengths > 1e-10][:, :dim - self.basis.shape[1]]
        return np.linalg.qr(new - self.basis @ (self.basis.T @ new))[0]


def fit_spectra(rows: DataFrame, components: int = COMPONENTS, block_rows: int = BLOCK_ROWS,
                rank: int = RANK) -> dict[int, Fit]:
    """The first ``components`` components of the vectors of each length."""
    found = _in_tree(rows.mapInArrow(_spectra(block_rows, rank), SPECTRA), SPECTRA,
                     _merged_spectra(rank), "spectra")
    fits = {}
    for r in found:
        axes = np.frombuffer(r["axes"]).reshape(r["dim"], -1)
        if not axes.shape[1]:  # all vectors are equal
            axes = np.eye(r["dim"])[:, :1]
        fits[r["dim"]] = Fit(r["n"], [int(s) for s in r["sums"]], np.linalg.qr(axes)[0])
    spans = {dim: Ritz(dim, components, fit.axes.shape[1]) for dim, fit in fits.items()}
    going = dict(fits)
    for _ in range(PASSES):
        products = _summed(rows, going, _product, "ritz") if going else {}
        for dim, product in products.items():
            fit = fits[dim]
            fit.trace = product[-1] / fit.n
            fit.axes = spans[dim].step(fit.axes, product[:-1].reshape(fit.axes.shape) / fit.n)
            if not fit.axes.shape[1]:
                going.pop(dim)
        if not going:
            break
    else:
        raise ArithmeticError(f"no convergence within {PASSES} passes")
    for dim, fit in fits.items():
        k = min(components, dim)
        more = max(0, k - len(spans[dim].values))  # vectors that span less have no variance there
        fit.values = np.pad(spans[dim].values[:k], (0, more))
        axes = np.pad(spans[dim].vectors[:, :k], ((0, 0), (0, more)))
        sign = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(k)])
        fit.axes = axes * sign
    for dim, moments in (_summed(rows, fits, _second_moment, "moments") if fits else {}).items():
        fit = fits[dim]
        k = int(fit.full.sum())
        mean, second = moments[:k] / fit.n, moments[k:].reshape(k, k) / fit.n
        fit.error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max(initial=0))
    return fits


WHITENED = ("vec_id long, n long, deviation decimal(38,0), whitened array<double>,"
            " explained array<double>, identity_error double")


def _whitened(fits):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in _whole(batch):
                fit = fits.value[dim]
                z = fit.whitened(x)
                k = z.shape[1]
                flat = pa.array(z.ravel(), mask=np.tile(~fit.full, len(x)))
                share = fit.values / fit.trace if fit.trace else np.zeros(k)
                cuts = pa.array(np.arange(0, k * len(x) + 1, k), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(at)),
                     pa.array(np.full(len(x), fit.n)),
                     pa.array(map(Decimal, fit.deviations(x)), pa.decimal128(38, 0)),
                     pa.ListArray.from_arrays(cuts, flat),
                     pa.ListArray.from_arrays(cuts, pa.array(np.tile(share, len(x)))),
                     pa.array(np.full(len(x), fit.error))],
                    ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows


def whiten(vectors: DataFrame, components: int = COMPONENTS, block_rows: int = BLOCK_ROWS,
           rank: int = RANK) -> DataFrame:
    """(vec_id, n, deviation, whitened, explained, identity_error) of every usable row of
    ``vectors`` (vec_id, embedding).

    Components c become x = floor(1024 c) + 100000. ``whitened`` holds, for each component, x less
    the mean, projected on the component, over the root of its eigenvalue; ``explained`` the
    components' shares of the variance. Signs are such that a component's largest entry is positive.

    Rows whose vector is null or empty, or holds null or non-finite entries, are left out. Vectors
    of different lengths are whitened among those of their own length. Repeated rows count each;
    rows without a vec_id take part. A component without variance (equal vectors, fewer vectors than
    components) has null whitened values. An empty table gives an empty one; other columns are left
    out. Components of 2^30 or more are refused.
    """
    rows = valid_vectors(vectors)
    fits = fit_spectra(rows, components, block_rows, rank)
    shared = vectors.sparkSession.sparkContext.broadcast(fits)  # components x dimensions numbers
    return rows.mapInArrow(_whitened(shared), WHITENED)


def op11_secular_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: up to eight whitened components of every vector, a row each. ``deviation``
    grows with the square of the table and is refused where it no longer fits a long."""
    found = whiten(table(spark, folder, "embeddings"))
    return found.select(
        "vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "x")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation",
        F.col("x.whitened").alias("whitened"), F.col("x.explained").alias("explained"),
        "identity_error")
