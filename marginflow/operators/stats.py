"""Statistics on the vendor frame: median split, Welch's t-test, correlations.

All are global aggregates (partial aggregation, one tiny final merge). The
median split comes back as a literal from the exact distributed percentile,
and the t tail is a Column expression, so the test itself is one aggregate
pass over the vendor frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.functions.quantiles import exact_percentile_value
from marginflow.functions.tdist import two_sided_p

from marginflow.constants import CORR_COLUMNS


def sales_tier_split(vendor: DataFrame, by: str = "TotalSalesDollars") -> DataFrame:
    """Top tier = at or above the median (the median vendor goes to the top)."""
    med = exact_percentile_value(vendor, by, 0.5)
    return vendor.withColumn("SalesTier", F.when(F.col(by) >= med, "top")
                             .when(F.col(by) < med, "bottom"))


def welch_ttest(vendor: DataFrame, value: str = "ProfitMargin",
                by: str = "TotalSalesDollars") -> DataFrame:
    """Welch's unequal-variance t-test, top vs bottom sales tier (two-sided)."""
    split = sales_tier_split(vendor, by).where(F.col("SalesTier").isNotNull())
    top, bot = F.col("SalesTier") == "top", F.col("SalesTier") == "bottom"
    v = F.col(value)
    s = split.agg(
        F.count_if(top & v.isNotNull()).alias("top_n"),
        F.count_if(bot & v.isNotNull()).alias("bottom_n"),
        F.avg(F.when(top, v)).alias("top_mean_margin"),
        F.avg(F.when(bot, v)).alias("bottom_mean_margin"),
        F.var_samp(F.when(top, v)).alias("_v1"),
        F.var_samp(F.when(bot, v)).alias("_v2"))
    se1 = F.col("_v1") / F.col("top_n")
    se2 = F.col("_v2") / F.col("bottom_n")
    se = se1 + se2
    valid = (F.col("top_n") >= 2) & (F.col("bottom_n") >= 2) & (se > 0)
    t = F.when(valid, (F.col("top_mean_margin") - F.col("bottom_mean_margin")) / F.sqrt(se))
    dof = F.when(valid, se * se / (se1 * se1 / (F.col("top_n") - 1)
                                   + se2 * se2 / (F.col("bottom_n") - 1)))
    out = s.withColumn("t_statistic", t).withColumn("df", dof)
    out = out.withColumn("p_value", two_sided_p(F.col("t_statistic"), F.col("df")))
    return out.select("top_n", "bottom_n", "top_mean_margin", "bottom_mean_margin",
                      "t_statistic", "df", "p_value",
                      (F.col("p_value") < 0.05).alias("significant_at_0_05"))


def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORR_COLUMNS,
                       digits: int | None = 3, heat_digits: int | None = 2) -> DataFrame:
    """Pearson r for every ordered pair, long form (metric_x, metric_y, corr, heat).

    Each pair uses its own complete rows, like pandas: covariance and both
    deviations skip a row where either value is NULL or NaN. A constant column
    gives NULL. One aggregate pass for any number of columns. ``corr`` is rounded
    to 3 places as in the report, ``heat`` to 2 as on the heatmap; ``None`` keeps
    r itself.
    """
    cols = list(columns)
    v = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    aggs = []
    for i, j in pairs:
        both = v[i].isNotNull() & v[j].isNotNull()
        aggs += [F.covar_pop(v[i], v[j]).alias(f"_c{i}_{j}"), F.stddev_pop(F.when(both, v[i])).alias(f"_x{i}_{j}"),
                 F.stddev_pop(F.when(both, v[j])).alias(f"_y{i}_{j}")]
    m = df.agg(*aggs)
    cells = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            p = f"{min(i, j)}_{max(i, j)}"
            r = F.col(f"_c{p}") / F.nullif(F.col(f"_x{p}") * F.col(f"_y{p}"), F.lit(0.0))
            cells.append(F.struct(F.lit(a).alias("metric_x"), F.lit(b).alias("metric_y"), r.alias("r")))
    shown = lambda n: F.col("c.r") if n is None else F.round("c.r", n)
    return (m.select(F.explode(F.array(*cells)).alias("c"))
             .select("c.metric_x", "c.metric_y", shown(digits).alias("corr"), shown(heat_digits).alias("heat")))
