"""Exact, linearly interpolated percentiles by distributed radix selection.

Spark's ``percentile``/``median`` merge every distinct value of a group in one
task, and a sketch is not exact. Here every value gets an order-preserving
position made of digits: its sign, binary exponent and first mantissa bits are
the first digit, the next mantissa bits the following ones. For each wanted rank

1. values are counted by their first digit, and running counts give the digit
   that holds the rank;
2. the values with that digit are counted by their next one, and so on;
3. what shares all digits (values within a relative 2^-36 of each other) is
   counted value by value.

Every pass is a partial and a final ``groupBy(group, rank, digit)``; a running
count sees at most 2^16 or so rows for each group and rank, whatever the number
of rows, map tasks or groups. The wanted digits are written as a table after each pass: a few
rows are then broadcast to the next pass, many (a lot of groups) are joined by
key. Groups stay a DataFrame throughout; a NULL group is a group. Calls without
groups need neither tables nor joins: see ``percentiles_of``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.session import written

#: Mantissa bits of the first digit, and of each further digit.
FIRST_BITS, DIGIT_BITS = 4, 16
DIGITS = 3
_EXPONENT_OFFSET = 1100   # above every binary exponent of a double, so that the first digit's sign is the value's


def _digits(x: Column) -> list[Column]:
    """The digits of a double (not NULL or NaN), each ascending with the value."""
    size = F.abs(x)
    finite = size < F.lit(float("inf"))
    exponent = F.when(~finite, F.lit(1024)).when(size > 0, F.floor(F.log2(size))).otherwise(F.lit(0)).cast("long")
    # in [1, 2) up to the rounding of log2; clipped values are told apart by the last pass
    mantissa = F.when(finite & (size > 0), size / F.pow(F.lit(2.0), exponent)).otherwise(F.lit(1.0))
    place = F.when(x < 0, F.lit(2.0) - mantissa).otherwise(mantissa - F.lit(1.0))
    place = F.greatest(F.lit(0.0), F.least(F.lit(1 - 2.0 ** -53), place))
    whole = [F.floor(place * F.lit(float(1 << (FIRST_BITS + i * DIGIT_BITS)))) for i in range(DIGITS)]
    sign = F.when(x > 0, F.lit(1)).when(x < 0, F.lit(-1)).otherwise(F.lit(0))
    first = F.when(x == 0, F.lit(0)).otherwise(
        sign * (exponent + _EXPONENT_OFFSET) * (1 << FIRST_BITS) + whole[0])
    return [first.cast("long")] + [(b - a * (1 << DIGIT_BITS)).cast("long") for a, b in zip(whole, whole[1:])]


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & a[k].eqNullSafe(b[k])
    return condition


def _ranked(counted: DataFrame, within: list[str], by: str) -> DataFrame:
    """Adds where each row's values start and end among those of its group."""
    w = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.withColumn("_end", F.sum("_c").over(w)).withColumn("_start", F.col("_end") - F.col("_c"))


def exact_percentiles(df: DataFrame, value: str | Column, ps: Sequence[float],
                      by: Sequence[str] = ()) -> DataFrame:
    """``(*by, p, value)``: exact linear-interpolation percentiles of every group.

    NULL and NaN values are ignored; a group without other values has no rows."""
    by, ps = list(by), [float(p) for p in ps]
    if not by:
        found = [(p, v) for p, v in zip(ps, percentile_values(df, value, ps)) if v is not None]
        return df.sparkSession.createDataFrame(found, "p double, value double")
    keys = [f"_g{i}" for i in range(len(by))]
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    groups = [F.col(b).alias(k) for b, k in zip(by, keys)]
    d = df.select(*groups, x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    names = [f"_d{i}" for i in range(DIGITS)]
    d = d.select(*keys, "_x", *[c.alias(n) for c, n in zip(_digits(F.col("_x")), names)])

    # the first pass counts all values, and so gives each group's size and ranks
    first = _ranked(d.groupBy(*keys, names[0]).agg(F.count(F.lit(1)).alias("_c")), keys, names[0])
    first = first.withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys)))
    last = F.col("_n") - 1
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(F.lit(p) * last), F.ceil(F.lit(p) * last)) for p in ps])))
    target = (first.withColumn("_k", F.explode(ranks)).where((F.col("_k") >= F.col("_start")) & (F.col("_k") < F.col("_end")))
              .select(*keys, "_n", "_k", (F.col("_k") - F.col("_start")).alias("_left"), names[0]))
    target = written(target, "percentile-digits")

    for i in range(1, DIGITS + 1):
        known, by_value = names[:i], i == DIGITS
        nxt = "_x" if by_value else names[i]
        hit = d.join(target, _same(d, target, [*keys, *known])).select(
            *[target[c] for c in (*keys, "_n", "_k", "_left", *known)], d[nxt])
        counted = hit.groupBy(*keys, "_n", "_k", "_left", *known, nxt).agg(F.count(F.lit(1)).alias("_c"))
        chosen = (_ranked(counted, [*keys, "_k"], nxt)
                  .where((F.col("_left") >= F.col("_start")) & (F.col("_left") < F.col("_end"))))
        keep = ["_x"] if by_value else [(F.col("_left") - F.col("_start")).alias("_left"), *known, nxt]
        target = written(chosen.select(*keys, "_n", "_k", *keep), "percentile-digits")

    # both order statistics of every p, interpolated
    picked = target.groupBy(*keys, "_n").agg(F.map_from_entries(F.collect_list(F.struct("_k", "_x"))).alias("_at"))
    p = F.explode(F.array(*[F.lit(p) for p in ps]))
    out = picked.select(*keys, "_at", (F.col("_n") - 1).alias("_last"), p.alias("p"))
    place = F.col("p") * F.col("_last")
    low, high = F.element_at("_at", F.floor(place)), F.element_at("_at", F.ceil(place))
    part, gap = place - F.floor(place), high - low
    between = F.when(low == high, low).when(part >= 0.5, high - gap * (1 - part)).otherwise(low + gap * part)
    return out.select(*[F.col(k).alias(b) for k, b in zip(keys, by)], "p", between.alias("value"))


def percentiles_of(df: DataFrame, wanted: Mapping[str, tuple[str | Column, Sequence[float]]]) -> dict[str, list[float | None]]:
    """Global percentiles of several columns at once: ``{name: (value, ps)}`` to
    ``{name: [percentile, ...]}`` (None where a column has no values).

    A call without groups looks for two ranks at most for each p, so the digits that hold
    them come back to the driver and are predicates of the next pass: a pass is one
    scan of all columns and one aggregate, with no table and no join. What comes back is at most
    2^16 or so counts for each rank, however many rows there are; the last pass, by
    value, gives back the ranks' own rows only."""
    names = list(wanted)
    values = [(F.col(v) if isinstance(v, str) else v).cast("double") for v, _ in wanted.values()]
    d = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("_m"), v.alias("_x")) for i, v in enumerate(values)])).alias("_s"))
    d = d.select("_s.*").where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    # column and digits so far as one number, so that a predicate evaluates them once
    first, *more = _digits(F.col("_x"))
    key = F.col("_m").cast("long") * F.lit(1 << 17) + first + F.lit(1 << 16)
    keys = [key]
    for digit in more:
        keys.append(keys[-1] * F.lit(1 << DIGIT_BITS) + digit)

    # ranks still looked for: key so far -> {rank: what is left of it among the values with this key}
    total: dict[int, int] = {}
    open_ranks: dict[int, dict[int, int]] = {}
    for depth in range(DIGITS):
        rows = d if not depth else d.where(keys[depth - 1].isin(list(open_ranks)))
        counted: dict[int, list] = {}
        for k, c in rows.groupBy(keys[depth].alias("_k")).agg(F.count(F.lit(1)).alias("_c")).collect():
            counted.setdefault(k >> (DIGIT_BITS if depth else 17), []).append((k, c))
        if not depth:
            for m, cells in counted.items():
                n = total[m] = sum(c for _, c in cells)
                open_ranks[m] = {k: k for p in wanted[names[m]][1] for k in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}
        found: dict[int, dict[int, int]] = {}
        for prefix, ranks in open_ranks.items():
            start = 0
            for digit, c in sorted(counted[prefix]):
                for k, left in ranks.items():
                    if start <= left < start + c:
                        found.setdefault(digit, {})[k] = left - start
                start += c
        open_ranks = found

    at: dict[tuple[int, int], float] = {}
    if open_ranks:
        counted = (d.where(keys[-1].isin(list(open_ranks))).groupBy(keys[-1].alias("_k"), "_x").agg(F.count(F.lit(1)).alias("_c")))
        hit = F.lit(False)
        for prefix, ranks in open_ranks.items():
            for left in set(ranks.values()):
                hit = hit | ((F.col("_k") == prefix) & (F.col("_start") <= left) & (F.col("_end") > left))
        for r in _ranked(counted, ["_k"], "_x").where(hit).collect():
            for k, left in open_ranks[r["_k"]].items():
                if r["_start"] <= left < r["_end"]:
                    at[r["_k"] >> (17 + (DIGITS - 1) * DIGIT_BITS), k] = r["_x"]

    out: dict[str, list[float | None]] = {}
    for m, name in enumerate(names):
        out[name] = [_between(at, m, p * (total[m] - 1)) if m in total else None for p in map(float, wanted[name][1])]
    return out


def _between(at: dict[tuple[int, int], float], m: int, place: float) -> float:
    low, high = at[m, math.floor(place)], at[m, math.ceil(place)]
    part, gap = place - math.floor(place), high - low
    if low == high:
        return low
    return high - gap * (1 - part) if part >= 0.5 else low + gap * part


def percentile_values(df: DataFrame, value: str | Column, ps: Sequence[float]) -> list[float | None]:
    """Global percentiles, one for each p (None for an empty input)."""
    return percentiles_of(df, {"value": (value, ps)})["value"]


def exact_percentile_value(df: DataFrame, value: str | Column, p: float) -> Column:
    """One global percentile as a literal Column (NULL for an empty input), which
    also lets Catalyst push predicates that use it into the scan."""
    return F.lit(percentile_values(df, value, [p])[0]).cast(T.DoubleType())


def exact_median(df: DataFrame, value: str | Column, by: Sequence[str] = ()) -> DataFrame:
    return exact_percentiles(df, value, [0.5], by).drop("p")
