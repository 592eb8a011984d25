"""Euclidean silhouette from a tree of balls, to a stated error.

Rows are sorted along a space-filling curve and cut into leaves of near rows of one
cluster; runs of ``FAN`` nodes form a node of the next level. A node has its count,
centre and scatter. The distances from a point to a node's rows sum up to no less than
count x D, D being the distance to the centre (the mean of distances is no less than the
distance to the mean), and to no more than count x sqrt(D^2 + variance). A node is
taken by these two bounds where they are near enough for every point of a leaf, and
opened where they are not, down to its rows, whose distances are summed exactly.

Each round is one join of leaves with the nodes that they still have open. A leaf opens
nodes near it only, so rows and nodes move, never pairs of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.constants import FEATURES
from marginflow.session import written

LEAF, FAN = 256, 8
#: Bits of each coordinate on the curve, and coordinates on it.
CURVE_BITS, CURVE_DIMS = 8, 7


def _curve(x: list, low: list[float], high: list[float]):
    """The place on the space-filling (Z-order) curve, from the first bits of each coordinate."""
    cells = []
    for c, a, b in list(zip(x, low, high))[:CURVE_DIMS]:
        share = (c - F.lit(a)) / F.lit(b - a) if b > a else F.lit(0.0)
        cells.append(F.least(F.floor(share * (1 << CURVE_BITS)).cast("long"), F.lit((1 << CURVE_BITS) - 1)))
    code = F.lit(0).cast("long")
    for bit in reversed(range(CURVE_BITS)):
        for c in cells:
            code = F.shiftleft(code, 1).bitwiseOR(F.shiftright(c, bit).bitwiseAND(F.lit(1)))
    return code


def _leaves(points: DataFrame, d: int, leaf: int) -> DataFrame:
    """(part, cl, seq, n, s0.., q, x): runs of at most ``leaf`` rows of one cluster, in the curve's order."""
    def cut(batches):
        from pyspark import TaskContext
        part, cl, seq, held = TaskContext.get().partitionId(), None, 0, []

        def close():
            nonlocal seq, held
            x = np.array(held, float)
            row = {"part": part, "cl": cl, "seq": seq, "n": len(x), "q": float((x * x).sum()), "x": x.tobytes(),
                   **{f"s{i}": float(v) for i, v in enumerate(x.sum(0))}}
            seq, held = seq + 1, []
            return row

        for batch in batches:
            out = []
            for c, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if c != cl:
                    if held:
                        out.append(close())
                    cl, seq = c, 0
                held.append(x)
                if len(held) == leaf:
                    out.append(close())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist([close()], schema)

    sums = [f"s{i}" for i in range(d)]
    schema = pa.schema([("part", pa.int32()), ("cl", pa.int32()), ("seq", pa.int64()), ("n", pa.int64()),
                        *((s, pa.float64()) for s in sums), ("q", pa.float64()), ("x", pa.binary())])
    return (points.repartitionByRange("cl", "code").sortWithinPartitions("cl", "code").select("cl", "x")
            .mapInArrow(cut, "part int, cl int, seq long, n long, " + ", ".join(f"{s} double" for s in sums) + ", q double, x binary"))


def _bounds(x: np.ndarray, centre: np.ndarray, variance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each point and node, the least and the greatest mean distance."""
    d2 = np.maximum((x * x).sum(1)[:, None] - 2 * x @ centre.T + (centre * centre).sum(1)[None, :], 0)
    return np.sqrt(d2), np.sqrt(d2 + variance[None, :])


def silhouette_tree(df: DataFrame, cols: Sequence[str] = FEATURES, cluster: str = "Cluster", relative: float = 0.01,
                    leaf: int = LEAF, fan: int = FAN) -> DataFrame:
    """One row: ``n``, ``silhouette``, and ``error``, the most by which it can differ from the exact
    mean silhouette. ``relative`` bounds the relative error of each mean distance, so
    ``error`` is below about twice that; 0 opens everything, and is exact.

    Rows with a NULL cluster, or a feature that is NULL or NaN, are left out. Singletons score 0; fewer than two
    clusters give NULL. Memory of a task: a leaf, and the nodes that it has open."""
    d = len(cols)
    x = [F.col(c).cast("double") for c in cols]
    usable = F.col(cluster).isNotNull()
    for c in x:
        usable = usable & c.isNotNull() & ~F.isnan(c)
    rows = df.where(usable)
    extent = rows.agg(F.count(F.lit(1)), F.count_distinct(cluster), *[F.min(c) for c in x], *[F.max(c) for c in x]).first()
    n, clusters, low, high = extent[0], extent[1], extent[2:2 + d], extent[2 + d:]
    if clusters < 2:
        return df.sparkSession.createDataFrame([(n, None, None)], "n long, silhouette double, error double")
    # around the middle, so that squared lengths keep their digits
    shift = [F.lit((a + b) / 2) for a, b in zip(low, high)]
    points = rows.select(F.col(cluster).cast("int").alias("cl"), _curve(x, low, high).alias("code"),
                         F.array(*[c - s for c, s in zip(x, shift)]).alias("x"))
    leaves = written(_leaves(points, d, leaf), "silhouette-leaves")
    sums = [f"s{i}" for i in range(d)]
    longest = leaves.agg(F.max("seq")).first()[0]
    levels = 0
    while fan ** levels <= longest:
        levels += 1
    stats = [F.sum(c).alias(c) for c in ("n", *sums, "q")]
    nodes = leaves.select("part", "cl", F.lit(0).alias("level"), F.col("seq").alias("at"), "n", *sums, "q")
    for level in range(1, levels + 1):
        nodes = nodes.unionByName(leaves.groupBy("part", "cl", F.floor(F.col("seq") / fan ** level).alias("at")).agg(*stats)
                                  .withColumn("level", F.lit(level)))
    nodes = written(nodes, "silhouette-nodes")
    node_cols = ["part", "cl", "level", "at", "n", *sums, "q"]

    def visit(key, mine: pd.DataFrame, open_: pd.DataFrame) -> pd.DataFrame:
        if mine.empty or open_.empty:
            return pd.DataFrame({c: [] for c in out_cols})
        x = np.frombuffer(mine["x"].iloc[0]).reshape(-1, d)
        count = open_["n"].to_numpy(float)
        labels = open_["cl"].to_numpy()
        centre = open_[sums].to_numpy(float) / count[:, None]
        variance = np.maximum(open_["q"].to_numpy(float) / count - (centre * centre).sum(1), 0)
        least, most = _bounds(x, centre, variance)
        taken = ((most - least) / 2 <= relative * least).all(0)
        held = open_["x"].notna().to_numpy()
        lower = {c: np.zeros(len(x)) for c in np.unique(labels)}
        upper = {c: np.zeros(len(x)) for c in lower}
        for c in lower:
            here = taken & ~held & (labels == c)
            lower[c] += least[:, here] @ count[here]
            upper[c] += most[:, here] @ count[here]
        for i in np.flatnonzero(held):          # a leaf's own rows
            other = np.frombuffer(open_["x"].iloc[i]).reshape(-1, d)
            exact = np.sqrt(((x[:, None, :] - other[None, :, :]) ** 2).sum(2)).sum(1)
            lower[labels[i]] += exact
            upper[labels[i]] += exact
        found = pd.concat([pd.DataFrame({"pos": np.arange(len(x)), "ref": c, "low": lower[c], "high": upper[c]}) for c in lower])
        more = open_.loc[~taken & ~held, ["part", "cl", "level", "at"]].rename(columns={"part": "npart", "cl": "ref"})
        out = pd.concat([found, more], ignore_index=True)
        for name in ("qpart", "qcl", "qseq"):
            out[name] = mine[name].iloc[0]
        return out[out_cols]

    out_cols = ["qpart", "qcl", "qseq", "pos", "ref", "low", "high", "npart", "level", "at"]
    out_schema = ("qpart int, qcl int, qseq long, pos long, ref int, low double, high double, "
                  "npart int, level int, at long")
    query = ["qpart", "qcl", "qseq"]
    mine = leaves.select(F.col("part").alias("qpart"), F.col("cl").alias("qcl"), F.col("seq").alias("qseq"), "x")
    # every leaf begins with the top nodes: one for each partition and cluster
    top = nodes.where(F.col("level") == levels).toPandas()
    top["x"] = None

    def begin(batches):
        for batch in batches:
            for i in range(len(batch)):
                yield visit(None, batch.iloc[i:i + 1], top)

    round_ = written(mine.mapInPandas(begin, out_schema), "silhouette-round")
    parts = []
    while True:
        parts.append(round_.where(F.col("pos").isNotNull()))
        opened = round_.where(F.col("at").isNotNull()).select(
            *query, F.col("npart").alias("part"), F.col("ref").alias("cl"), "level", "at")
        if opened.isEmpty():
            break
        inner = opened.where("level > 0").select(
            *query, "part", "cl", (F.col("level") - 1).alias("level"),
            F.explode(F.sequence(F.col("at") * fan, F.col("at") * fan + (fan - 1))).alias("at"))
        inner = inner.join(nodes, ["part", "cl", "level", "at"]).withColumn("x", F.lit(None).cast("binary"))
        rows_ = opened.where("level = 0").join(leaves.withColumnRenamed("seq", "at"), ["part", "cl", "at"])
        pairs = written(inner.select(*query, *node_cols, "x").unionByName(rows_.select(*query, *node_cols, "x")), "silhouette-pairs")
        round_ = written(mine.groupBy(*query).cogroup(pairs.groupBy(*query)).applyInPandas(visit, out_schema), "silhouette-round")

    total = parts[0]
    for p in parts[1:]:
        total = total.unionByName(p)
    per = total.groupBy(*query, "pos", "ref").agg(F.sum("low").alias("low"), F.sum("high").alias("high"))
    sizes = {r["cl"]: r["n"] for r in leaves.groupBy("cl").agg(F.sum("n").alias("n")).collect()}     # k rows
    size = F.element_at(F.create_map(*[v for c, m in sizes.items() for v in (F.lit(c), F.lit(float(m)))]), F.col("ref"))
    own = F.col("ref") == F.col("qcl")
    others = F.when(own, F.nullif(size - 1, F.lit(0.0))).otherwise(size)
    mean = per.select(*query, "pos", own.alias("own"), (F.col("low") / others).alias("low"), (F.col("high") / others).alias("high"))
    point = mean.groupBy(*query, "pos").agg(
        F.max(F.when(F.col("own"), F.col("low"))).alias("a0"), F.max(F.when(F.col("own"), F.col("high"))).alias("a1"),
        F.min(F.when(~F.col("own"), F.col("low"))).alias("b0"), F.min(F.when(~F.col("own"), F.col("high"))).alias("b1"))

    def score(a, b):
        value = F.coalesce((b - a) / F.nullif(F.greatest(a, b), F.lit(0.0)), F.lit(0.0))
        return F.when(F.col("a0").isNull(), F.lit(0.0)).otherwise(value)

    worst, best = score(F.col("a1"), F.col("b0")), score(F.col("a0"), F.col("b1"))
    return point.agg(F.count(F.lit(1)).alias("n"), F.avg((worst + best) / 2).alias("silhouette"),
                     F.avg((best - worst) / 2).alias("error"))
