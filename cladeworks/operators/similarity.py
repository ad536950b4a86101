"""Pairs of sequences within a Hamming distance, by blocked equi-join.

Sequences of one length that differ in at most d places, cut at the same places into d + r segments, agree in r of them at
least. So the choices of r segments are joined, and a pair is verified only at its first r agreeing segments, which
needs no distinct. One segment of d + 1 is a long enough key for long, sparse barcodes; short or dense ones fill every key, and
choices of more segments have longer keys. How many pairs each r would bring together is counted on the keys before any is made. Strings no longer
than d cannot be cut so; there are few of them, and they are compared with each other. AQE splits keys that many sequences share.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeworks.functions.sequences import hamming
from cladeworks.runtime import materialize, sized

#: Segments chosen together at most, and the candidates a row below which one segment is good enough.
MOST_CHOSEN, FEW_CANDIDATES = 4, 64


def _segments(seq: Column, n: int) -> list[Column]:
    cuts = [F.floor(F.length(seq) * i / n).cast("int") for i in range(n + 1)]
    return [F.substring(seq, a + 1, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _keys(rows: DataFrame, name: str, d: int, r: int) -> DataFrame:
    """``rows`` by each choice of r of d + r segments: its number ``at``, the number of its last segment, and its text; with all segments."""
    segments = _segments(F.col(name), d + r)
    choices = [F.struct(F.lit(i).alias("at"), F.lit(chosen[-1]).alias("last"), F.concat(*[segments[k] for k in chosen]).alias("key")) for i, chosen in enumerate(combinations(range(d + r), r))]
    held = rows.select(name, F.length(name).alias("len"), *[s.alias(f"{name}_{k}") for k, s in enumerate(segments)], F.array(*choices).alias("choices"))
    return held.select(*held.columns[:-1], F.inline("choices"))


def candidates(a: DataFrame, b: DataFrame, d: int, chosen: list[int]) -> dict[int, tuple[int, int]]:
    """By r, the pairs that choices of r segments bring together, counted on the keys, and the rows of these keys. One pass over both sides."""
    side = lambda x, name, r, one: _keys(x, name, d, r).select(F.lit(r).alias("r"), "len", "at", "key", F.lit(one).alias("one"), F.lit(1 - one).alias("two"))
    held = reduce(DataFrame.unionByName, [side(x, name, r, one) for r in chosen for x, name, one in ((a, "b1", 1), (b, "b2", 0))])
    held = held.groupBy("r", "len", "at", "key").agg(F.sum("one").alias("one"), F.sum("two").alias("two"))
    counted = held.groupBy("r").agg(F.sum(F.col("one").cast("double") * F.col("two")).alias("met"), F.sum(F.col("one") + F.col("two")).alias("rows")).collect()  # a row an r
    return {x.r: (int(x.met), int(x.rows)) for x in counted}


def segments_chosen(a: DataFrame, b: DataFrame, d: int) -> int:
    """The r whose rows and candidates are fewest; more than one is only looked at where one brings many together."""
    found = candidates(a, b, d, [1])
    met, keys = found.get(1, (0, 0))
    if met > FEW_CANDIDATES * keys / (d + 1):
        found |= candidates(a, b, d, list(range(2, MOST_CHOSEN + 1)))
    return min(found, key=lambda r: (sum(found[r]), r), default=1)


def hamming_pairs(left: DataFrame, right: DataFrame, d: int, strict_length: bool = False) -> DataFrame:
    """``(b1, b2, distance)`` of the distinct non-null values of the only column of each side.

    Of unequal lengths the distance is the longer one, so only strings up to d long can match, unless
    ``strict_length`` rules such pairs out.
    """
    a = left.toDF("b1").dropna().distinct()
    b = right.toDF("b2").dropna().distinct()
    if d == 0:
        return a.join(b, F.col("b1") == F.col("b2")).withColumn("distance", F.lit(0))
    a, b = materialize(a), materialize(b)
    cut1, cut2 = a.where(F.length("b1") > d), b.where(F.length("b2") > d)
    r = segments_chosen(cut1, cut2, d)
    met = _keys(cut1, "b1", d, r).join(_keys(cut2, "b2", d, r).drop("last"), ["len", "at", "key"])
    agree = [(F.col(f"b1_{k}") == F.col(f"b2_{k}")).cast("int") for k in range(d + r)]
    # All chosen segments agree, so they are the first ones if no other up to the last of them does.
    first = sum((F.when(F.col("last") >= k, same).otherwise(0) for k, same in enumerate(agree)), F.lit(0)) == r
    long_ones = met.where(first).select("b1", "b2", hamming(F.col("b1"), F.col("b2")).alias("distance"))
    short1, short2 = a.where(F.length("b1") <= d), b.where(F.length("b2") <= d)
    # Two strings of at most d letters are always within d, so without ``strict_length`` all their pairs are the result.
    same = F.length("b1") == F.length("b2") if strict_length else F.lit(True)
    short = short1.join(sized(short2), same).select("b1", "b2", hamming(F.col("b1"), F.col("b2")).alias("distance"))
    return long_ones.unionByName(short).where(F.col("distance") <= d)
