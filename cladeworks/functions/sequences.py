"""Column functions on sequences and matches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wsn_mismatches(seq: Column) -> Column:
    """Bases out of the repeating pattern (A or T, G or C, any); an ambiguous base mismatches."""
    first, second = F.regexp_replace(seq, "(?s)(.).?.?", "$1"), F.regexp_replace(seq, "(?s).(.?).?", "$1")
    return (F.length(F.translate(first, "AT", "")) + F.length(F.translate(second, "GC", ""))).cast("int")


def hamming(a: Column, b: Column) -> Column:
    """Differing places; of strings that differ in length, the longer length."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int"))
    equal = F.aggregate(pairs, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(1)))
    return F.when(F.length(a) == F.length(b), equal).otherwise(F.greatest(F.length(a), F.length(b)))


def strict_hamming(a: Column, b: Column) -> Column:
    """``hamming`` that raises on strings of different lengths."""
    return F.when(F.length(a) != F.length(b), F.raise_error(F.lit("sequences differ in length")).cast("int")).otherwise(hamming(a, b))


def match_confidence(umi1: Column, umi2: Column, rank1: Column, rank2: Column) -> Column:
    """0.7 of the balance of UMIs plus 0.3 of the agreement of ranks, within 0 and 1."""
    least, most = F.greatest(F.least(umi1, umi2), F.lit(0)), F.greatest(umi1, umi2, F.lit(0))
    balance = F.when(most > 0, least / F.nullif(most, F.lit(0))).otherwise(0.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.7 * balance + 0.3 / (1 + F.abs(rank1 - rank2))))


def greedy_one_to_one(matches: Column) -> Column:
    """From ``array<struct<distance, t1, t0>>`` the pairs taken in the order of (distance, t1, t0), each barcode once."""
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("t1"), empty.alias("t0"), F.filter(matches, lambda _: F.lit(False)).alias("taken"))

    def step(acc: Column, m: Column) -> Column:
        free = ~F.array_contains(acc["t1"], m["t1"]) & ~F.array_contains(acc["t0"], m["t0"])
        add = lambda name: F.when(free, F.concat(acc[name], F.array(m[name]))).otherwise(acc[name]).alias(name)
        return F.struct(add("t1"), add("t0"), F.when(free, F.concat(acc["taken"], F.array(m))).otherwise(acc["taken"]).alias("taken"))

    return F.aggregate(F.array_sort(matches), start, step, lambda acc: acc["taken"])
