"""Exact tests and fits that Spark has no function for."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeworks.runtime import ranged, sized

#: Tables whose chance is within this factor of the observed one count as no more likely.
NEAR = 1 + 1e-7
#: Factorials below this are looked up; beyond it Stirling's series is as exact as doubles are.
TABLE = 32
#: A tail is summed from its edge until terms are below the edge's by this many units of the natural logarithm.
NEGLIGIBLE = 45.0


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def log_factorial(x: Column) -> Column:
    """The logarithm of a factorial as a column expression."""
    known = F.array(*[F.lit(math.lgamma(k + 1)) for k in range(TABLE)])
    z = x.cast("double")
    square = 1 / (z * z)
    series = (z + 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + (((1 / 1260 - square / 1680) * square - 1 / 360) * square + 1 / 12) / z
    return F.when(x < TABLE, F.get(known, x.cast("int"))).otherwise(series)


def _chance(x: Column) -> Column:
    """Logarithm of the chance of ``x`` in the first cell, given the margins ``_row``, ``_col`` and ``_n``, up to the constant ``_fixed``."""
    cells = F.array(x, F.col("_row") - x, F.col("_col") - x, F.col("_n") - F.col("_row") - F.col("_col") + x)
    return F.col("_fixed") - F.aggregate(cells, F.lit(0.0), lambda s, k: s + log_factorial(k))


def _last_place(high: Column, goes_on: Callable[[Column], Column]) -> Column:
    """The last place from 0 to before ``high`` up to which ``goes_on`` holds, by bisection; -1 if it does not hold at 0."""
    start = F.struct(F.lit(-1).cast("long").alias("low"), high.cast("long").alias("high"))
    steps = F.sequence(F.lit(1), F.ceil(F.log2(high.cast("double") + 2)).cast("int") + 1)

    def halve(held: Column, half: Column) -> Column:
        low = (half > held["low"]) & goes_on(half)
        return F.when(low, F.struct(half.alias("low"), held["high"].alias("high"))).otherwise(F.struct(held["low"].alias("low"), F.greatest(half, held["low"] + 1).alias("high")))

    return F.aggregate(steps, start, lambda held, _: _let(F.floor((held["low"] + held["high"]) / 2), lambda half: halve(held, half)), lambda held: held["low"])


def fisher_tables(tables: DataFrame) -> DataFrame:
    """``(a, b, c, d, p)`` of distinct 2 by 2 tables of counts: the sum of the hypergeometric chances that are no greater than the observed one.

    The chances rise up to the mode and fall beyond it, so the tables that count are two tails. The inner end of each is found by bisection, and
    so is the place further out from which terms no longer matter; what lies between is a row a term, summed by table.
    """
    # Few bytes but much work a row: partitions stay as many as configured instead of being joined by size.
    t = tables.select("a", "b", "c", "d").repartition(int(tables.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b", "c", "d").distinct()
    t = t.withColumns({"_row": F.col("a") + F.col("b"), "_col": F.col("a") + F.col("c"), "_n": F.col("a") + F.col("b") + F.col("c") + F.col("d")})
    margins = F.array(F.struct("_row", F.lit(1).alias("w")), F.struct((F.col("_n") - F.col("_row")).alias("_row"), F.lit(1).alias("w")), F.struct(F.col("_col").alias("_row"), F.lit(1).alias("w")), F.struct((F.col("_n") - F.col("_col")).alias("_row"), F.lit(1).alias("w")), F.struct(F.col("_n").alias("_row"), F.lit(-1).alias("w")))
    mode = F.floor((F.col("_row") + 1).cast("double") * (F.col("_col") + 1) / (F.col("_n") + 2)).cast("long")
    t = t.withColumns({
        "_fixed": F.aggregate(margins, F.lit(0.0), lambda s, m: s + m["w"] * log_factorial(m["_row"])),
        "_low": F.greatest(F.lit(0).cast("long"), F.col("_row") + F.col("_col") - F.col("_n")), "_high": F.least("_row", "_col"), "_mode": mode,
    })
    t = t.withColumn("_mode", F.least(F.greatest("_mode", "_low"), "_high")).withColumn("_limit", _chance(F.col("a")) + math.log(NEAR))
    # Places of a tail count from its outermost table inwards; -1 where not even that one is within the limit.
    tails = t.withColumn("_whole", _chance(F.col("_mode")) <= F.col("_limit")).select("*", F.inline(F.array(F.struct(F.col("_low").alias("_edge"), F.lit(1).alias("_by")), F.struct(F.col("_high").alias("_edge"), F.lit(-1).alias("_by")))))
    at = lambda k: _chance(F.col("_edge") + F.col("_by") * k)
    tails = tails.withColumn("_inner", F.when(F.col("_whole"), -1).otherwise(_last_place(F.abs(F.col("_mode") - F.col("_edge")) + 1, lambda k: at(k) <= F.col("_limit"))))
    tails = tails.withColumn("_least", at(F.greatest(F.col("_inner"), F.lit(0))) - NEGLIGIBLE)
    tails = tails.withColumn("_outer", F.when(F.col("_inner") > 0, _last_place(F.col("_inner"), lambda k: at(k) < F.col("_least"))).otherwise(-1))
    places = F.when(F.col("_inner") >= 0, F.sequence(F.col("_outer") + 1, F.col("_inner"))).otherwise(F.array(F.lit(None).cast("long")))
    terms = tails.select("a", "b", "c", "d", "_row", "_col", "_n", "_fixed", "_whole", "_edge", "_by", F.explode(places).alias("k"))
    terms = terms.withColumn("x", F.col("_edge") + F.col("_by") * F.col("k"))
    terms = terms.withColumns({"y": F.col("_row") - F.col("x"), "z": F.col("_col") - F.col("x"), "w": F.col("_n") - F.col("_row") - F.col("_col") + F.col("x")})
    chance = F.when(F.col("x").isNull(), 0.0).otherwise(F.exp(F.col("_fixed") - log_factorial(F.col("x")) - log_factorial(F.col("y")) - log_factorial(F.col("z")) - log_factorial(F.col("w"))))
    return terms.groupBy("a", "b", "c", "d").agg(F.when(F.max("_whole"), 1.0).otherwise(F.least(F.lit(1.0), F.sum(chance))).alias("p"))


def with_fisher_p(df: DataFrame, a: Column, b: Column, c: Column, d: Column, p: str) -> DataFrame:
    """``df`` with the two-sided exact test of each row's table of counts; each distinct table is tested once."""
    keyed = df.withColumns({f"_ft_{n}": x.cast("long") for n, x in zip("abcd", (a, b, c, d), strict=True)})
    tested = fisher_tables(keyed.select(*[F.col(f"_ft_{n}").alias(n) for n in "abcd"])).toDF(*[f"_ft_{n}" for n in "abcd"], p)
    return keyed.join(tested, [f"_ft_{n}" for n in "abcd"]).select(*[keyed[x] for x in df.columns], p)


def exact_median(df: DataFrame, value: str) -> float | None:
    """The median of the non-null values: the mean of the middle two, or the middle one.

    Equal values are counted first and the distinct ones range-sorted. The counts of the ranges say which one
    holds a middle value, and only that one is summed up; no task sees more than a range.
    """
    values = ranged(df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("n")), F.col("v"))
    parts = values.groupBy("_part").agg(F.sum("n").alias("n")).orderBy("_part").collect()  # a row a partition
    total = sum(r.n for r in parts)
    if not total:
        return None
    middle, before = {(total - 1) // 2, total // 2}, 0
    found = []
    for part, n in parts:
        here = [k - before for k in middle if before <= k < before + n]
        if here:
            up_to = F.sum("n").over(Window.orderBy("_nth"))  # of one range
            rows = values.where(F.col("_part") == part).select("v", (up_to - F.col("n")).alias("first"), up_to.alias("end"))
            found += [rows.where((F.col("first") <= k) & (F.col("end") > k)).first().v for k in here]
        before += n
    return float(sum(found)) / len(found)


def benjamini_hochberg(df: DataFrame, p: str, q: str) -> DataFrame:
    """``df`` with step-up q values. Equal p values share one, so they are counted first.

    The distinct values are range-sorted; a rank is the rows of the ranges before plus those before inside
    the range, and the least of what follows is likewise taken over ranges and inside each.
    """
    values = ranged(df.groupBy(F.col(p).alias("_bh_p")).agg(F.count("*").alias("_bh_n")), F.asc_nulls_first("_bh_p"))
    inside = Window.partitionBy("_part").orderBy("_nth")
    ranges = values.groupBy("_part").agg(F.sum("_bh_n").alias("rows"))  # a row a partition
    ranges = ranges.select("_part", (F.sum("rows").over(Window.orderBy("_part")) - F.col("rows")).alias("before"), F.sum("rows").over(Window.partitionBy()).alias("all"))
    rank = F.col("before") + F.sum("_bh_n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    stepped = values.join(sized(ranges), "_part").withColumn("_bh_v", F.col("_bh_p") * F.col("all") / rank)
    onward = stepped.groupBy("_part").agg(F.min("_bh_v").alias("least"))
    onward = onward.select("_part", F.min("least").over(Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)).alias("later"))
    # From the end on, so that a row adds itself to what is known; a frame to the end would be gone through again for each row.
    here = F.min("_bh_v").over(Window.partitionBy("_part").orderBy(F.desc("_nth")).rowsBetween(Window.unboundedPreceding, 0))
    known = stepped.join(sized(onward), "_part").select(F.col("_bh_p").alias(p), F.when(F.col("_bh_p").isNotNull(), F.least(F.lit(1.0), here, F.coalesce("later", F.lit(1.0)))).alias(q))
    return df.join(known, df[p].eqNullSafe(known[p])).select(*[df[c] for c in df.columns], known[q])


@dataclass(frozen=True)
class PoissonFit:
    observed_mean: float
    rate: float
    ks_statistic: float
    p_value: float
    percent_infected: float
    values: list[int]
    empirical: list[int]
    expected: list[float]


def truncated_rate(mean: float) -> float:
    """The rate of a zero-truncated Poisson of this mean; 0 at a mean of 1 or less."""
    if mean <= 1:
        return 0.0
    low, high = 0.0, mean
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if mid / -math.expm1(-mid) < mean else (low, mid)
    return (low + high) / 2


def ks_equal_sizes(a: list[float], b: list[float]) -> tuple[float, float]:
    """Two-sample Kolmogorov-Smirnov statistic and exact p value of samples of one size."""
    n = len(a)
    points = sorted({*a, *b})
    gap = max((abs(sum(x <= p for x in a) - sum(x <= p for x in b)) for p in points), default=0)
    if gap == 0:
        return 0.0, 1.0
    total = math.comb(2 * n, n)
    p = 2 * sum((-1) ** (k - 1) * math.comb(2 * n, n - k * gap) for k in range(1, n // gap + 1)) / total
    return gap / n, min(1.0, max(0.0, p))


def fit_truncated_poisson(counts: dict[int, int]) -> PoissonFit:
    """From the histogram of lineages per cell (a row a distinct number). Both CDFs are cut to the shorter one by place."""
    values = sorted(counts)
    total = sum(counts.values())
    mean = sum(v * n for v, n in counts.items()) / total
    rate = truncated_rate(mean)
    most = values[-1]
    if rate:
        chance = [math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) / -math.expm1(-rate) for k in range(1, most + 1)]
    else:
        chance = [1.0] + [0.0] * (most - 1)
    n = min(len(values), most)
    empirical = np.cumsum([counts[v] / total for v in values])[:n].tolist()
    expected = np.cumsum(chance)[:n].tolist()
    statistic, p = ks_equal_sizes(empirical, expected)
    return PoissonFit(float(mean), float(rate), float(statistic), float(p), -math.expm1(-rate) * 100, values[:n], [counts[v] for v in values[:n]], [c * total for c in chance[:n]])
