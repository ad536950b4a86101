"""Pairs of cells listed block by block: the rows of a brute force, and few rows shuffled."""

import random

import pytest
from pyspark.sql import functions as F

from cladeworks import config
from cladeworks.operators import clones, pairs
from tests.test_blocks import shuffled, sharing

COLUMNS = "source string, cell string, barcode string, umi double, rank double, barcodes long"


def apart(a, b):
    return sum(x != y for x, y in zip(a, b, strict=True)) if len(a) == len(b) else max(len(a), len(b))


def expected(one, two, p, every):
    cells = lambda rows: {k: [r for r in rows if r[:2] == k] for k in dict.fromkeys(r[:2] for r in rows)}
    out = {}
    for x, left in cells(one).items():
        for y, right in cells(one if two is None else two).items():
            if two is None and x[1] >= y[1]:
                continue
            near = []
            for _, _, a, u1, r1, n1 in left:
                for _, _, b, u2, r2, n2 in right:
                    if apart(a, b) <= p.hamming_threshold:
                        near.append((a, b, apart(a, b), 0.7 * min(u1, u2) / max(u1, u2) + 0.3 / (1 + abs(r1 - r2)), u1, u2, r1, r2))
            near.sort()
            exact = [m for m in near if m[2] == 0]
            scan = left[0][5] * right[0][5]
            chosen, compared = near, scan
            if exact and p.quick_mode:
                chosen, compared = (exact + near, len(exact) + scan) if p.force_hamming_all else (exact, len(exact))
            least = min(apart(a[2], b[2]) for a in left for b in right)
            text = ";".join(f"{a}|{b}|d:{d}|c:{c:.4f}|u1:{u1:.0f}|u2:{u2:.0f}|r1:{r1:.0f}|r2:{r2:.0f}" for a, b, d, c, u1, u2, r1, r2 in chosen)
            if near:
                same = sum(m[2] == 0 for m in chosen)
                out[x, y] = (True, len(chosen), same, len(chosen) - same, compared, least, least, round(sum(m[3] for m in chosen) / len(chosen), 9), text)
            elif every:
                out[x, y] = (False, 0, 0, 0, len({r[2] for r in left}) * len({r[2] for r in right}), least, None, None, "")
    return out


@pytest.mark.parametrize(("p", "small"), [(config.CloneParams(2), False), (config.CloneParams(0), True), (config.CloneParams(1, False), True), (config.CloneParams(1, True, True), True)])
def test_pairs_match_brute_force(spark, monkeypatch, p, small):
    """Barcodes of several lengths, rows given twice, and blocks and slices that cut every side."""
    if small:
        for name, value in (("BLOCKS", 4), ("GRID", 3), ("BLOCK_ROWS", 3), ("MATCHES", 20), ("PAIRS", 15), ("DISTANCES", 40)):
            monkeypatch.setattr(pairs, name, value)
    rnd = random.Random(p.hamming_threshold)
    pool = ["".join(rnd.choice("AC") for _ in range(rnd.choice((2, 6, 7)))) for _ in range(25)]

    def rows(source, n):
        out = [(source, f"c{i}", b, float(rnd.randrange(1, 9)), float(rnd.randrange(1, 5)), 3) for i in range(n) for b in rnd.sample(pool, rnd.randrange(1, 5))]
        return out + [(*r[:3], r[3] + 1, *r[4:]) for r in out[::9]]

    one, two = rows("x", 16), rows("y", 11)
    a, b = (spark.createDataFrame(x, COLUMNS).cache() for x in (one, two))
    for every, run in ((False, clones.clone_pairs), (True, clones.all_pairs)):
        for other, held in ((None, None), (b, two)):
            found = run(a, other, p).collect()
            got = {((r.source_condition_1, r.cell_barcode_1), (r.source_condition_2, r.cell_barcode_2)): (
                r.is_clone, r.num_matches, r.num_exact_matches, r.num_hamming_matches, r.num_barcode_comparisons, r.min_observed_distance, r.best_hamming_distance,
                r.mean_match_confidence and round(r.mean_match_confidence, 9), r.matched_barcode_pairs) for r in found}
            assert len(got) == len(found) and got == expected(one, held, p, every)


def test_cells_without_pairs(spark):
    none = spark.createDataFrame([], COLUMNS)
    one = spark.createDataFrame([("x", "c", "ACGT", 1.0, 1.0, 1)], COLUMNS)
    assert clones.clone_pairs(none).count() == clones.all_pairs(none).count() == clones.clone_pairs(one, none).count() == clones.all_pairs(one).count() == 0


@pytest.mark.parametrize("run", [clones.clone_pairs, clones.all_pairs])
def test_pairs_of_one_family_are_listed_without_rows_for_them(spark, run):
    n = 1200
    rows = sharing(spark, n).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("cell"), "barcode", F.lit(1.0).alias("umi"), F.lit(1.0).alias("rank"), F.lit(12).alias("barcodes")).cache()
    rows.count()
    found = []
    records, size = shuffled(spark, lambda: found.append(run(rows, p=config.CloneParams(hamming_threshold=0)).selectExpr("count(*)", "count(matched_barcode_pairs)").first()))
    assert found[0][0] > 0.95 * n * (n - 1) / 2 and records < 300_000 and size < 30_000_000


def block(n, first, last=(2, 3)):
    import pyarrow as pa

    own = pa.list_(pa.struct([("barcode", pa.string()), ("umi", pa.float64()), ("rank", pa.float64())]))
    rows = [{"one": "s", "two": f"{first}{i:015d}", "n": 2, "distinct": 2, "own": [{"barcode": f"{'ACGT'[i % 4] * 13}{'ACGT'[k] * 11}", "umi": 1.0, "rank": 1.0} for k in ((i % 3, 3) if i < n - 1 else last)]} for i in range(n)]
    return pa.Table.from_pylist(rows, pa.schema([("one", pa.string()), ("two", pa.string()), ("n", pa.int64()), ("distinct", pa.int64()), ("own", own)]))


@pytest.mark.parametrize("within", [False, True])
def test_all_pairs_leave_a_task_as_tiles(within):
    """Few bytes a pair, where a row each had more than 100."""
    one, two = block(400, "a"), block(400, "a" if within else "b")
    given = list(pairs.Meeting(pairs.Cells(one), pairs.Cells(two), None, config.CloneParams(hamming_threshold=0), within, False).batches())
    seen = [x for b in given for x in b["seen"].flatten().to_pylist()]
    total = 400 * 399 // 2 if within else 400 * 400
    assert sum(x != pairs.NONE for x in seen) == total and sum(x < pairs.NONE for x in seen) == sum(len(b["num_matches"].flatten()) for b in given)
    assert sum(b.nbytes for b in given) < 45 * total


def test_all_pairs_of_cells_without_barcodes(spark):
    one = spark.createDataFrame([("x", "a", "ACGT", 1.0, 1.0, 1), ("x", "b", None, 1.0, 1.0, 1), ("x", "c", "ACGA", 2.0, 1.0, 1), ("x", "d", "ACGA", 2.0, 1.0, 1)], COLUMNS)
    found = {(r.cell_barcode_1, r.cell_barcode_2): (r.is_clone, r.min_observed_distance, r.num_barcode_comparisons, r.best_hamming_distance, r.num_matches, r.matched_barcode_pairs) for r in clones.all_pairs(one, p=config.CloneParams(0)).collect()}
    none = lambda d, n: (False, d, n, None, 0, "")
    assert found.pop(("c", "d"))[:5] == (True, 0, 1, 0, 1)
    assert found == {("a", "b"): none(None, 0), ("a", "c"): none(1, 1), ("a", "d"): none(1, 1), ("b", "c"): none(None, 0), ("b", "d"): none(None, 0)}


def test_matched_cells_are_the_ends_of_pairs(spark):
    """Without a list of pairs: nothing leaves Spark for a Python worker."""
    rnd = random.Random(7)
    pool = ["".join(rnd.choice("ACGT") for _ in range(rnd.choice((5, 6)))) for _ in range(120)]
    rows = lambda source, n: [(source, f"c{i}", b, 1.0, 1.0, 2) for i in range(n) for b in rnd.sample(pool, 2)] + [(source, f"c{n}", None, 1.0, 1.0, 1), (source, "c0", pool[0], 1.0, 1.0, 3)]
    one, two = (spark.createDataFrame(x, COLUMNS).cache() for x in (rows("x", 30), rows("y", 20) + [("y", "alone", "T" * 9, 1.0, 1.0, 1)]))
    for p in (config.CloneParams(0), config.CloneParams(1)):
        for other in (None, two):
            pairs_ = clones.clone_pairs(one, other, p).collect()
            ends = [{(r.cell_barcode_1, r.source_condition_1) for r in pairs_}, {(r.cell_barcode_2, r.source_condition_2) for r in pairs_}]
            found = clones.matched_cells(one, other, p)
            assert "InArrow" not in found._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(tuple, found.collect())) == sorted(ends[0] | ends[1]) and pairs_
        for side in (1, 2):
            assert sorted(map(tuple, clones.matched_cells(one, two, p, side).collect())) == sorted(ends[side - 1])


@pytest.mark.parametrize("within", [False, True])
@pytest.mark.parametrize(("owned", "last", "made"), [(pairs.OWNED, (2, 3), {0}), (pairs.OWNED, (2,), {0, 11}), (0, (2, 3), {0, 11})])
def test_quick_pairs_make_exact_matches_alone(monkeypatch, within, owned, last, made):
    """Near matches are only made for rows with a pair that has no exact one; the last cell of a block may make such pairs."""
    import pyarrow as pa

    monkeypatch.setattr(pairs, "OWNED", owned)
    p, one = config.CloneParams(hamming_threshold=11), block(60, "a", last)
    two = one if within else block(60, "b", last)
    names = sorted({x["barcode"] for row in one["own"].to_pylist() for x in row})
    links = pa.Table.from_pylist([{"one": a, "two": b, "n": apart(a, b)} for a in names for b in names if apart(a, b) <= 11])
    met = pairs.Meeting(pairs.Cells(one), pairs.Cells(two), links, p, within, True)
    found = {(r["cell_barcode_1"], r["cell_barcode_2"]): (r["num_exact_matches"], r["num_hamming_matches"], r["best_hamming_distance"], r["matched_barcode_pairs"].count(";") + 1) for b in met.batches() for r in b.to_pylist()}
    want = {}
    for x in one.to_pylist():
        for y in two.to_pylist():
            near = [apart(a["barcode"], b["barcode"]) for a in x["own"] for b in y["own"] if apart(a["barcode"], b["barcode"]) <= 11]
            if near and (x["two"] < y["two"] or not within):
                exact = near.count(0)
                want[x["two"], y["two"]] = (exact, 0 if exact else len(near), min(near), exact or len(near))
    assert found == want and set(met.distance[met.link].tolist()) == made


@pytest.mark.parametrize("within", [False, True])
@pytest.mark.parametrize("some", [pairs.PAIRS, 100])
def test_exact_pairs_without_texts_are_summed_by_barcode(monkeypatch, within, some):
    """The rows of the other way, and no match is one."""
    import pyarrow as pa

    monkeypatch.setattr(pairs, "PAIRS", some)
    rnd = random.Random(some)

    def varied(first):
        rows = block(50, first).to_pylist()
        for row in rows:
            for own in row["own"]:
                own |= {"umi": float(rnd.randrange(1, 30)), "rank": float(rnd.randrange(1, 9))}
            row["own"].sort(key=lambda x: x["barcode"])
        return pa.Table.from_pylist(rows, block(1, first).schema)

    one = varied("a")
    two = one if within else varied("b")
    names = sorted({x["barcode"] for row in one["own"].to_pylist() for x in row})
    links = pa.Table.from_pylist([{"one": a, "two": b, "n": apart(a, b)} for a in names for b in names if apart(a, b) <= 11])

    def rows(texts):
        met = pairs.Meeting(pairs.Cells(one), pairs.Cells(two), links, config.CloneParams(hamming_threshold=11), within, texts)
        return sorted((tuple(r[c] for c in pairs.NAMES[:-1]) for b in met.batches() for r in b.to_pylist()))

    want = rows(True)
    monkeypatch.delattr(pairs.Meeting, "_matches")
    assert rows(False) == want and want
    every = [x for b in pairs.Meeting(pairs.Cells(one), pairs.Cells(two), None, config.CloneParams(hamming_threshold=0), within, False).batches() for x in b.to_pylist()]
    told = [sorted(x[k] for r in every for x in zip(*(r[c] for c in pairs.FOUND), strict=True)) for k in (0, 1, 5)]
    assert told == [sorted(r[pairs.NAMES.index(c)] for r in want) for c in ("num_matches", "num_exact_matches", "mean_match_confidence")]
