"""KMeans with all restarts fitted together.

Rows are packed once into blocks of near rows (split at the median of the widest
dimension) with their mean, radius and scatter. From then on, one pass over the
blocks serves every restart:

* k-means++ seeds: a round draws, for each restart, the row with the least
  ``-ln(u) / D^2``, where ``u`` comes from a hash of the row's key; that is a draw
  in proportion to ``D^2``, the same on any partitioning;
* Lloyd steps: a pass gives one aggregate over (restart, cluster) of counts, sums
  and inertia; restarts that have come to rest drop out;
* distances are skipped by the triangle inequality: a centre farther from a block's
  mean than the nearest one by twice the block's radius is nearest to none of its
  rows, and a block with one centre left is counted from its mean and scatter alone.

What reaches the driver is restarts x clusters x (dimensions + 2) numbers a pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.session import written

#: Rows of a block.
BLOCK = 512
#: Squared distances that are equal to this many places, in units of about the rows' variance, count as
#: ties, which go to the lower cluster id.
PLACES = 9
#: Draws: a row's hash (1 to 2^28) times a power of the multiplier, modulo a prime.
PRIME, MULTIPLIER, ROUNDS = 2_147_483_647, 48_271, 64


@dataclass(frozen=True)
class KMeansFit:
    """``centres``: an array of k rows; ``inertia``: the rows' summed squared distances
    to their nearest centre; ``restart`` and ``passes``: the restart that won, and its Lloyd passes;
    ``unit``: the power of two next to the rows' variance."""
    centres: np.ndarray
    inertia: float
    restart: int
    passes: int
    unit: float


def draw_multiplier(seed: int, restart: int, round_: int) -> int:
    return pow(MULTIPLIER, (seed + restart) * ROUNDS + round_ + 1, PRIME)


def _row_hash(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 7), 16, 10).cast("long") + 1


def _near_rows(x: np.ndarray, rows: int) -> Iterator[np.ndarray]:
    """Indexes of at most ``rows`` rows each, that lie near one another."""
    stack = [np.arange(len(x))]
    while stack:
        i = stack.pop()
        if len(i) <= rows:
            yield i
            continue
        widest = int(np.argmax(x[i].max(0) - x[i].min(0)))
        half = len(i) // 2
        order = np.argpartition(x[i, widest], half)
        stack += [i[order[half:]], i[order[:half]]]


def point_blocks(df: DataFrame, features: str | Column, key: str | Column | None = None, rows: int = BLOCK) -> DataFrame:
    """The rows of ``df`` as blocks. ``features``: an array or vector of numbers; rows where
    it, or a number in it, is null or NaN are left out. ``key`` tells rows apart in
    the draws (default: the features themselves)."""
    from pyspark.ml.functions import vector_to_array
    kind = df.select(features).schema[0].dataType.typeName()
    x = F.col(features) if isinstance(features, str) else features
    x = vector_to_array(x) if kind == "vectorudt" else x.cast("array<double>")
    points = df.select(x.alias("x"), *([] if key is None else [(F.col(key) if isinstance(key, str) else key)
                                                              .cast("string").alias("key")]))
    if key is None:
        points = points.withColumn("key", F.col("x").cast("string"))
    points = points.where(F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))
    points = points.select(F.coalesce("key", F.lit("")).alias("key"), "x").withColumn("h", _row_hash(F.col("key")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, lists, h = batch.column(0), batch.column(1), batch.column(2).to_numpy()
            x = lists.flatten().to_numpy().reshape(batch.num_rows, -1)
            for i in _near_rows(x, rows):
                mean = x[i].mean(0)
                away = ((x[i] - mean) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys.take(pa.array(i)).to_pylist()], pa.list_(pa.string())),
                    pa.array([h[i].tobytes()]), pa.array([np.ascontiguousarray(x[i]).tobytes()]),
                    pa.array([mean.tobytes()]), pa.array([float(np.sqrt(away.max()))]), pa.array([float(away.sum())])],
                    ["keys", "h", "x", "mean", "radius", "scatter"])

    return points.select("key", "x", "h").mapInArrow(
        pack, "keys array<string>, h binary, x binary, mean binary, radius double, scatter double")


def _squares(x: np.ndarray, mean: np.ndarray, centres: np.ndarray, unit: float) -> np.ndarray:
    """Squared distances (rows, centres), rounded; taken around the block's mean."""
    a, b = x - mean, centres - mean
    exact = np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0)
    return np.round(exact / unit, PLACES) * unit


def _numbers(blob: bytes, kind=np.float64) -> np.ndarray:
    return np.frombuffer(blob, kind)


def _draw(blocks: DataFrame, chosen: np.ndarray, restarts: list[int], seed: int, round_: int,
          unit: float) -> dict[int, np.ndarray]:
    """The next seed of each restart; ``chosen``: (restarts, seeds so far, dimensions)."""
    factors = np.array([draw_multiplier(seed, r, round_) for r in restarts], np.int64)

    def race(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        for batch in batches:
            for keys, h, x, mean in zip(*(batch.column(i).to_pylist() for i in range(4))):
                mean = _numbers(mean)
                x = _numbers(x).reshape(-1, len(mean))
                u = (_numbers(h, np.int64)[:, None] * factors[None, :] % PRIME) / PRIME
                weight = np.ones_like(u)
                if round_:
                    d = _squares(x, mean, chosen.reshape(-1, len(mean)), unit)
                    weight = d.reshape(len(x), len(restarts), round_).min(2)
                with np.errstate(divide="ignore"):
                    time = np.where(weight > 0, -np.log(u) / weight, np.inf)
                for r in range(len(restarts)):
                    least = time[:, r].min()
                    if np.isfinite(least):
                        k, i = min((keys[i], i) for i in np.flatnonzero(time[:, r] == least))
                        if r not in best or (least, k) < best[r][:2]:
                            best[r] = float(least), k, x[i].tobytes()
        if best:
            yield pa.RecordBatch.from_pydict({
                "restart": pa.array(list(best), pa.int32()), "time": [b[0] for b in best.values()],
                "key": [b[1] for b in best.values()], "x": [b[2] for b in best.values()]})

    found = (blocks.select("keys", "h", "x", "mean").mapInArrow(race, "restart int, time double, key string, x binary")
             .groupBy("restart").agg(F.min_by("x", F.struct("time", "key")).alias("x")).collect())   # a row for each restart
    return {r["restart"]: _numbers(r["x"]) for r in found}


def seed_centres(blocks: DataFrame, k: int, restarts: list[int], seed: int, unit: float = 1.0) -> list[np.ndarray]:
    """k-means++ seeds of each restart; fewer than ``k`` where there are fewer distinct rows."""
    chosen: list[list[np.ndarray]] = [[] for _ in restarts]
    for round_ in range(k):
        so_far = np.array(chosen) if round_ else np.zeros((len(restarts), 0, 0))
        drawn = _draw(blocks, so_far, restarts, seed, round_, unit)
        if len(drawn) < len(restarts):      # all rows are seeds already, for every restart alike
            break
        for r, x in drawn.items():
            chosen[r].append(x)
    return [np.array(c) for c in chosen]


def lloyd_pass(blocks: DataFrame, centres: np.ndarray, unit: float = 1.0) -> np.ndarray:
    """(restarts, clusters, dimensions + 2): sums, count and inertia of the rows nearest to each
    of ``centres`` (restarts, clusters, dimensions)."""
    restarts, k, d = centres.shape
    slack = 10.0 ** -(PLACES // 2) * unit ** 0.5     # what rounding may hide

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((restarts, k, d + 2))
        for batch in batches:
            for x, mean, radius, scatter in zip(*(batch.column(i).to_pylist() for i in range(4))):
                mean = _numbers(mean)
                n = len(x) // (8 * d)
                away = np.sqrt(((centres - mean) ** 2).sum(2))
                near = away <= away.min(1, keepdims=True) + 2 * radius + slack
                only = near.sum(1) == 1
                for r in np.flatnonzero(only):     # the whole block is one centre's
                    c = int(np.argmax(near[r]))
                    total[r, c, :d] += n * mean
                    total[r, c, d] += n
                    total[r, c, d + 1] += scatter + n * away[r, c] ** 2
                if only.all():
                    continue
                x = _numbers(x).reshape(n, d)
                for r in np.flatnonzero(~only):
                    cs = np.flatnonzero(near[r])
                    far = _squares(x, mean, centres[r, cs], unit)
                    best = far.argmin(1)
                    member = np.equal.outer(np.arange(len(cs)), best).astype(float)
                    total[r, cs, :d] += member @ x
                    total[r, cs, d] += member.sum(1)
                    total[r, cs, d + 1] += member @ far[np.arange(n), best]
        r, c, dim = np.nonzero(total)
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int32)), pa.array(c.astype(np.int32)),
                                              pa.array(dim.astype(np.int32)), pa.array(total[r, c, dim])],
                                             ["restart", "cluster", "dim", "value"])

    parts = blocks.select("x", "mean", "radius", "scatter").mapInArrow(
        assign, "restart int, cluster int, dim int, value double")
    out = np.zeros((restarts, k, d + 2))
    sums = parts.groupBy("restart", "cluster", "dim").agg(F.sum("value").alias("value")).toArrow()
    out[tuple(sums[c].to_numpy() for c in ("restart", "cluster", "dim"))] = sums["value"].to_numpy()
    return out


def _unit(blocks: DataFrame, d: int) -> float:
    """The power of two next to the rows' variance, all dimensions together; 1 where rows do not vary."""
    total = lloyd_pass(blocks, np.zeros((1, 1, d)))[0, 0]
    n, variance = total[d], total[d + 1] / total[d] - ((total[:d] / total[d]) ** 2).sum()
    return 2.0 ** round(np.log2(variance)) if n and variance > 1e-12 * total[d + 1] / n else 1.0


def fit(blocks: DataFrame, k: int, n_init: int, seed: int, max_iter: int = 300, tol: float = 1e-9,
        initial: np.ndarray | None = None) -> KMeansFit | None:
    """The restart of least inertia (ties: the first). A restart rests when no centre
    moves by more than ``tol`` (in units of the rows' spread); an empty cluster keeps its centre. ``initial`` gives the
    starting centres, (restarts, k, dimensions), instead of drawing them. None without rows."""
    first = blocks.select("mean").first()
    if first is None:
        return None
    unit = _unit(blocks, len(_numbers(first[0])))
    restarts = list(range(n_init if initial is None else len(initial)))
    seeds = seed_centres(blocks, k, restarts, seed, unit) if initial is None else list(np.asarray(initial, float))
    centres, resting = np.array(seeds), {}
    for passes in range(1, max_iter + 1):
        active = [r for r in restarts if r not in resting]
        if not active:
            break
        sums = lloyd_pass(blocks, centres[active], unit)
        counts, inertia = sums[:, :, -2], sums[:, :, -1].sum(1)
        moved = np.where(counts[:, :, None] > 0, sums[:, :, :-2] / np.maximum(counts, 1)[:, :, None], centres[active])
        step = np.sqrt(((moved - centres[active]) ** 2).sum(2)).max(1)
        for i, r in enumerate(active):
            if step[i] <= tol * unit ** 0.5 or passes == max_iter:
                resting[r] = KMeansFit(centres[r].copy(), float(inertia[i]), r, passes, unit)
        centres[active] = moved
    least = min(f.inertia for f in resting.values())
    # inertias that only rounding tells apart are ties
    return next(resting[r] for r in restarts if resting[r].inertia <= least * (1 + 1e-12) + 1e-12)


def kmeans(df: DataFrame, features: str | Column, k: int, n_init: int, seed: int, key: str | Column | None = None,
           max_iter: int = 300, tol: float = 1e-9) -> KMeansFit | None:
    """``fit`` over the rows of ``df``, packed and written as blocks first."""
    blocks = written(point_blocks(df, features, key), "kmeans-blocks").cache()      # read again by every pass
    try:
        return fit(blocks, k, n_init, seed, max_iter, tol)
    finally:
        blocks.unpersist()


def nearest_centre(df: DataFrame, centres: np.ndarray, features: str, out: str, unit: float = 1.0) -> DataFrame:
    """``df`` with the id of the nearest centre (ties to the lower); NULL without usable features."""
    from pyspark.ml.functions import vector_to_array
    x = F.col(features)
    x = vector_to_array(x) if df.schema[features].dataType.typeName() == "vectorudt" else x.cast("array<double>")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ok = batch.column(batch.num_columns - 1)
                points = ok.fill_null([0.0] * centres.shape[1]).flatten().to_numpy().reshape(batch.num_rows, -1)
                best = _squares(points, centres.mean(0), centres, unit).argmin(1)
                ids = pa.array(best.astype(np.int32), mask=np.asarray(ok.is_null()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], schema=pa.schema(
                    [*list(batch.schema)[:-1], pa.field(out, pa.int32())]))

    keep = [c for c in df.columns if c not in (features, out)]
    usable = F.when(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v)), x)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*[f"`{c}`" for c in keep]).schema)
    return df.select(*[F.col(f"`{c}`") for c in keep], usable.alias("__x")).mapInArrow(
        assign, f"{schema}{', ' if keep else ''}`{out}` int")


def renumbered(assigned: DataFrame, cluster: str, key: str) -> DataFrame:
    """Cluster ids 0, 1, ... by their least key, so that equal partitions have equal ids."""
    from pyspark.sql import Window
    first = assigned.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.min(f"`{key}`").alias("__first"))
    new = (F.row_number().over(Window.orderBy("__first")) - 1).cast("int")          # k rows
    ids = first.select(F.col(cluster).alias("__old"), new.alias("__new"))
    return (assigned.join(F.broadcast(ids), F.col(cluster) == F.col("__old"), "left")
            .withColumn(cluster, F.col("__new")).select(*assigned.columns))
