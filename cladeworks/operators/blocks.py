"""Sets of barcodes compared block by block, without a row for each pair that meets or for each barcode that it shares.

Rows with a set of barcodes each are ordered by the barcode of theirs that most rows own, and cut into at most ``BLOCKS`` blocks a side. Two blocks
with a pair of near barcodes meet in one task, where tiles of both are compared as matrices. A row is sent to each block that
it may meet, so what is shuffled is linear in the rows however many own a barcode; only results leave the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeworks.runtime import materialize, numbered, sized

#: Blocks a side at most, rows of a block at least; rows of a tile on either side, links compared together.
BLOCKS, BLOCK_ROWS = 64, 1024
TILE_LEFT, TILE_RIGHT, TOGETHER = 1024, 2048, 512


def _placed(rows: DataFrame, facts: DataFrame, codes: DataFrame, block: str) -> DataFrame:
    """``(block, id, keys, values, facts)`` of ``(id, barcode, value)`` and ``(id, facts)``; rows without a near barcode are left out."""
    coded = rows.join(codes, "barcode").select("id", "code", F.col("value").cast("long").alias("value"))
    owners = coded.groupBy("code").agg(F.count("*").alias("owners"))
    each = coded.join(owners, "code").groupBy("id").agg(F.min(F.struct(-F.col("owners"), "code")).alias("hub"), F.collect_list(F.struct("code", "value")).alias("own"))
    each = numbered(each.join(facts, "id"), "nth", F.col("hub"), F.col("id"))
    size = max(BLOCK_ROWS, -(-each.count() // BLOCKS))
    return materialize(each.select(F.expr(f"cast((nth - 1) div {size} as int)").alias(block), "id", F.col("own.code").alias("keys"), F.col("own.value").alias("values"), "facts"))


class Side:
    """Rows of a block: ``ids`` ascending, ``facts`` a row each, and their barcodes."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("id")
        lists = {c: table[c].combine_chunks() for c in ("keys", "values")}
        lists = {c: x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for c, x in lists.items()}
        self.ids = table["id"].to_numpy()
        lengths = np.diff(lists["keys"].offsets.to_numpy())
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.keys, self.values = (np.asarray(x.flatten()) for x in lists.values())
        self.facts = np.array(table["facts"].to_pylist(), dtype=np.int64).reshape(len(self.ids), -1)

    def tile(self, low: int, high: int) -> Side:
        part = object.__new__(Side)
        a, b = self.starts[low], self.starts[min(high, len(self.ids))]
        part.ids, part.facts, part.keys, part.values = self.ids[low:high], self.facts[low:high], self.keys[a:b], self.values[a:b]
        part.starts = self.starts[low : high + 1] - a
        return part

    def tiles(self, size: int) -> Iterator[Side]:
        return (self.tile(i, i + size) for i in range(0, len(self.ids), size))

    def dense(self, codes: np.ndarray, values: bool = False) -> np.ndarray:
        """A row each of ``codes``, which ascend, a column a row of the tile: 1 or the value where it owns the barcode."""
        out = np.zeros((len(codes), len(self.ids)), np.int64 if values else np.float32)
        if len(codes):
            at = np.minimum(np.searchsorted(codes, self.keys), len(codes) - 1)
            held = codes[at] == self.keys
            out[at[held], np.repeat(np.arange(len(self.ids)), np.diff(self.starts))[held]] = self.values[held] if values else 1
        return out


class Links:
    """Pairs of near barcodes by the left one, and their distances."""

    def __init__(self, a: np.ndarray, b: np.ndarray, distance: np.ndarray):
        order = np.lexsort((b, a))
        self.a, self.b, self.distance = a[order], b[order], distance[order]

    def where(self, kept: np.ndarray) -> Links:
        return Links(self.a[kept], self.b[kept], self.distance[kept])

    def between(self, left: Side, right: Side) -> Links:
        return self.where(np.isin(self.a, left.keys) & np.isin(self.b, right.keys))

    def slices(self, whole: bool) -> Iterator[Links]:
        """About ``TOGETHER`` links each; with ``whole`` all of a left barcode stay together."""
        low = 0
        while low < len(self.a):
            high = min(low + TOGETHER, len(self.a))
            if whole:
                high = max(int(np.searchsorted(self.a, self.a[high - 1], "left")) if high < len(self.a) else high, low)
                high = high if high > low else int(np.searchsorted(self.a, self.a[low], "right"))
            yield Links(self.a[low:high], self.b[low:high], self.distance[low:high])
            low = high


def matched(left: Side, right: Side, links: Links) -> np.ndarray:
    """By pair of rows, the barcodes of the left one that have a near one in the right one."""
    out = np.zeros((len(left.ids), len(right.ids)), np.float32)
    for some in links.between(left, right).slices(whole=True):
        codes, first = np.unique(some.a, return_index=True)
        ends, place = np.unique(some.b, return_inverse=True)
        out += left.dense(codes).T @ np.maximum.reduceat(right.dense(ends)[place], first, axis=0)
    return out


def compare(left: DataFrame, left_facts: DataFrame, right: DataFrame, right_facts: DataFrame, near: DataFrame, judge: Callable[[Side, Side, Links], Iterator[list[np.ndarray]]], schema: str) -> DataFrame:
    """Rows that ``judge`` gives for the tiles of all blocks that meet; a pair of rows is in one tile.

    Sides are ``(id long, barcode, value)``, each barcode once an id, with ``(id, facts array<long>)``; ``near`` is ``(b1, b2, distance)``. Barcodes are
    numbered in their order. Ids ascend in a tile.
    """
    codes = near.select(F.col("b1").alias("barcode")).unionByName(near.select(F.col("b2").alias("barcode"))).distinct()
    codes = materialize(numbered(codes, "code", F.col("barcode")).withColumn("code", F.col("code").cast("long")))
    end = lambda b, c: codes.select(F.col("barcode").alias(b), F.col("code").alias(c))
    links = materialize(near.join(end("b1", "a"), "b1").join(end("b2", "b"), "b2").select("a", "b", F.col("distance").cast("long").alias("distance")))
    one, two = _placed(left, left_facts, codes, "lb"), _placed(right, right_facts, codes, "rb")
    held = lambda df, block, c: df.select(block, F.explode("keys").alias(c)).distinct()
    own = materialize(held(one, "lb", "a").join(links, "a"))
    met = sized(materialize(own.select("lb", "b").distinct().join(held(two, "rb", "b"), "b").select("lb", "rb").distinct()))
    ties = own.groupBy("lb", "a").agg(F.collect_list(F.struct("b", "distance")).alias("own"))
    empty = F.array().cast("array<bigint>")
    ties = ties.select("lb", F.lit(True).alias("link"), F.col("a").alias("id"), F.col("own.b").alias("keys"), F.col("own.distance").alias("values"), empty.alias("facts"))
    sent = one.select("lb", F.lit(False).alias("link"), "id", "keys", "values", "facts").unionByName(ties).join(met, "lb")
    # Few bytes but much work: partitions stay as many as configured instead of being joined by size.
    parts = int(near.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = [df.repartition(parts, "lb", "rb").groupBy("lb", "rb") for df in (sent, two.join(met, "rb"))]
    names = [x.split()[0] for x in schema.split(", ")]

    def run(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        tied = ours.filter(ours["link"])
        lengths = np.array([len(x) for x in tied["keys"].to_pylist()], dtype=np.int64)
        flat = lambda c: np.asarray(tied[c].combine_chunks().flatten()) if len(tied) else np.zeros(0, np.int64)
        near_ = Links(np.repeat(tied["id"].to_numpy(), lengths), flat("keys"), flat("values"))
        lefts, rights = Side(ours.filter(pc.invert(ours["link"]))), Side(theirs)
        found = [rows for a in lefts.tiles(TILE_LEFT) for b in rights.tiles(TILE_RIGHT) for rows in judge(a, b, near_)]
        return pa.table({n: np.concatenate([np.asarray(x[i], np.int64) for x in found]) if found else np.zeros(0, np.int64) for i, n in enumerate(names)})

    return grouped[0].cogroup(grouped[1]).applyInArrow(run, schema)


def count_met(left: Side, right: Side, links: Links) -> Iterator[list[np.ndarray]]:
    """``[id, n]``: the first fact of all right rows with a near barcode, summed."""
    n = (matched(left, right, links) > 0) @ right.facts[:, 0]
    yield [left.ids[n > 0], n[n > 0]]


def most_similar(top_n: int) -> Callable[[Side, Side, Links], Iterator[list[np.ndarray]]]:
    """``[left id, right id, matched]`` of the ``top_n`` best of the tile by matched over the union of both first facts, ties by id."""

    def judge(left: Side, right: Side, links: Links) -> Iterator[list[np.ndarray]]:
        m = matched(left, right, links).astype(np.int64)
        union = left.facts[:, :1] + right.facts[:, 0] - m
        score = np.where((m > 0) & (union != 0), m / np.where(union == 0, 1, union), -np.inf)
        every = np.arange(len(left.ids))
        for _ in range(min(top_n, len(right.ids))):
            best = score.argmax(axis=1)
            kept = score[every, best] > -np.inf
            if not kept.any():
                break
            yield [left.ids[kept], right.ids[best[kept]], m[every, best][kept]]
            score[every, best] = -np.inf

    return judge


def _least_values(left: Side, right: Side, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By pair of rows, the lesser of both values summed over the given pairs of barcodes that are in the left row alone and the right row alone, or in both if equal."""
    out = np.zeros((len(left.ids), len(right.ids)), np.int64)
    for low in range(0, len(a), TOGETHER):
        x, y = a[low : low + TOGETHER], b[low : low + TOGETHER]
        codes = np.union1d(x, y)
        ours, theirs = left.dense(codes, True), right.dense(codes, True)
        has, have = left.dense(codes) > 0, right.dense(codes) > 0
        for i, j in zip(np.searchsorted(codes, x), np.searchsorted(codes, y), strict=True):
            rows = np.flatnonzero(has[i] if i == j else has[i] & ~has[j])
            columns = np.flatnonzero(have[j] if i == j else have[j] & ~have[i])
            if len(rows) and len(columns):
                if len(rows) * len(columns) * 4 < out.size:
                    out[np.ix_(rows, columns)] += np.minimum(ours[i, rows][:, None], theirs[j, columns])
                else:
                    u = np.where(has[i] if i == j else has[i] & ~has[j], ours[i], 0)
                    v = np.where(have[j] if i == j else have[j] & ~have[i], theirs[j], 0)
                    out += np.minimum(u[:, None], v)
    return out


def one_to_one(least_matched: int, threshold: float, weighted: bool, top_n: int) -> Callable[[Side, Side, Links], Iterator[list[np.ndarray]]]:
    """``[left id, right id, matched, distance, shared]`` of pairs whose greedy one-to-one matches reach the threshold; facts are barcodes and UMIs.

    Equal barcodes are always taken, as nothing else has distance 0. Of the others only near pairs without an equal partner
    in the other row are left: none or one is taken as it is, and where there are more they are gone through in order, if with all of
    them the pair could reach the threshold. With ``top_n`` what is below the tile's ``top_n``-th score of a left row is left out.
    """

    def judge(left: Side, right: Side, links: Links) -> Iterator[list[np.ndarray]]:
        same = np.intersect1d(np.unique(left.keys), np.unique(right.keys))
        shape = (len(left.ids), len(right.ids))
        equal, more, far = (np.zeros(shape, np.float32) for _ in range(3))
        for low in range(0, len(same), TOGETHER):
            some = same[low : low + TOGETHER]
            equal += left.dense(some).T @ right.dense(some)
        others = links.between(left, right)
        others = others.where(others.distance > 0)
        for some in others.slices(whole=False):
            codes = np.union1d(some.a, some.b)
            i, j = np.searchsorted(codes, some.a), np.searchsorted(codes, some.b)
            ours, theirs = left.dense(codes), right.dense(codes)
            ours, theirs = ours[i] * (1 - ours[j]), theirs[j] * (1 - theirs[i])
            more += ours.T @ theirs
            far += (ours * some.distance[:, None].astype(np.float32)).T @ theirs
        equal, more, far = (x.astype(np.int64) for x in (equal, more, far))
        n1, n0 = left.facts[:, :1], right.facts[:, 0]
        most = equal + np.minimum(more, np.minimum(n1, n0) - equal)
        shared = np.zeros(shape, np.int64)
        if weighted:
            total = left.facts[:, 1:2] + right.facts[:, 1]
            shared = _least_values(left, right, same, same) + _least_values(left, right, others.a, others.b)
            score = lambda: np.where(total - shared > 0, shared / np.where(total - shared > 0, total - shared, 1), 0.0)
        else:
            score = lambda: most / np.maximum(n1 + n0 - most, 1)
        fits = lambda: (most >= max(least_matched, 1)) & (score() >= threshold)
        for i, j in zip(*np.nonzero(fits() & (more > 1)), strict=True):
            ours = dict(zip(left.keys[left.starts[i] : left.starts[i + 1]].tolist(), left.values[left.starts[i] : left.starts[i + 1]].tolist(), strict=True))
            theirs = dict(zip(right.keys[right.starts[j] : right.starts[j + 1]].tolist(), right.values[right.starts[j] : right.starts[j + 1]].tolist(), strict=True))
            alone1, alone0 = np.array(sorted(ours.keys() - theirs.keys())), np.array(sorted(theirs.keys() - ours.keys()))
            kept = np.isin(others.a, alone1) & np.isin(others.b, alone0)
            used1, used0, taken = set(), set(), []
            for d, a, b in sorted(zip(others.distance[kept].tolist(), others.a[kept].tolist(), others.b[kept].tolist(), strict=True)):
                if a not in used1 and b not in used0:
                    used1.add(a)
                    used0.add(b)
                    taken.append((d, a, b))
            most[i, j], far[i, j] = equal[i, j] + len(taken), sum(d for d, _, _ in taken)
            if weighted:
                shared[i, j] = sum(min(u, theirs[b]) for b, u in ours.items() if b in theirs) + sum(min(ours[a], theirs[b]) for _, a, b in taken)
        reached = np.where(fits(), score(), -np.inf)
        if top_n and shape[1] > top_n:
            reached[reached < np.partition(reached, -top_n, axis=1)[:, -top_n :].min(axis=1)[:, None]] = -np.inf
        i, j = np.nonzero(reached > -np.inf)
        yield [left.ids[i], right.ids[j], most[i, j], far[i, j], shared[i, j]]

    return judge
