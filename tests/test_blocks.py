"""Rows compared block by block: the same pairs as by brute force, and few rows shuffled where many cells share barcodes."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cladeworks import config
from cladeworks.operators import blocks, clones, direct, timepoints


def shuffled(spark, run):
    """Records and bytes that ``run`` writes to shuffles."""
    context = spark.sparkContext
    new = lambda: context._jvm.java.util.ArrayList()

    def total():
        stages = context._jsc.sc().statusStore().stageList(new(), False, False, context._gateway.new_array(context._jvm.double, 0), new())
        stages = [stages.apply(i) for i in range(stages.size())]
        return np.array([sum(s.shuffleWriteRecords() for s in stages), sum(s.shuffleWriteBytes() for s in stages)])

    before = total()
    run()
    return total() - before


def table(rows):
    return pa.table({"id": list(rows), "keys": [list(x) for x in rows.values()], "values": [list(x.values()) for x in rows.values()], "facts": [[len(x), sum(x.values())] for x in rows.values()]}, pa.schema([("id", pa.int64()), *[(c, pa.list_(pa.int64())) for c in ("keys", "values", "facts")]]))


@pytest.mark.parametrize("together", [2, 512])
@pytest.mark.parametrize(("weighted", "top"), [(False, 0), (True, 0), (True, 2)])
def test_tiles_match_brute_force(monkeypatch, together, weighted, top):
    monkeypatch.setattr(blocks, "TOGETHER", together)
    rnd = random.Random(together + weighted + top)
    make = lambda n: {i: {k: rnd.randrange(1, 9) for k in rnd.sample(range(12), rnd.randrange(1, 7))} for i in range(n)}
    one, two = make(30), make(25)
    distance = {(a, b): 0 if a == b else 1 + (a + b) % 2 for a in range(12) for b in range(12) if abs(a - b) <= 2}
    links = blocks.Links(*(np.array(x) for x in zip(*[(a, b, d) for (a, b), d in distance.items()], strict=True)))
    left, right = blocks.Side(table(one)), blocks.Side(table(two))
    want = {}
    for i, x in one.items():
        for j, y in two.items():
            taken = []
            for d, a, b in sorted((distance[a, b], a, b) for a in x for b in y if (a, b) in distance):
                if a not in [t[1] for t in taken] and b not in [t[2] for t in taken]:
                    taken.append((d, a, b))
            shared, m = sum(min(x[a], y[b]) for _, a, b in taken) if weighted else 0, len(taken)
            score = shared / (sum(x.values()) + sum(y.values()) - shared) if weighted else m / (len(x) + len(y) - m)
            if m >= 2 and score >= 0.3:
                want[i, j] = (m, sum(t[0] for t in taken), shared, score)
    if top:
        best = {i: sorted((v[3] for (k, _), v in want.items() if k == i), reverse=True)[:top] for i in one}
        want = {k: v for k, v in want.items() if v[3] >= best[k[0]][-1]}
    got = {(i, j): (m, d, s) for x in blocks.one_to_one(2, 0.3, weighted, top)(left, right, links) for i, j, m, d, s in zip(*(c.tolist() for c in x), strict=True)}
    assert got == {k: v[:3] for k, v in want.items()}
    met = {(i, j): sum(any((a, b) in distance for b in y) for a in x) for i, x in one.items() for j, y in two.items()}
    found = blocks.matched(left, right, links)
    assert {(i, j): int(found[i, j]) for i, j in met} == met


def sharing(spark, n):
    """Cells of one family: each has about half of 24 barcodes, no two the same ones."""
    seq = "concat_ws('', transform(sequence(0, 11), i -> substr('ACGT', cast(pmod(hash(i, k), 4) as int) + 1, 1)))"
    return spark.range(n).selectExpr("id", "explode(sequence(0, 23)) AS k").where("pmod(hash(id, k, 7), 2) = 0").selectExpr("id", f"{seq} AS barcode", "1L AS umi")


def test_cells_of_one_family_are_matched_without_rows_for_pairs(spark):
    n = 1500
    rows = sharing(spark, n).selectExpr("cast(id as string) AS cell_barcode", "barcode AS corrected_lineage_barcode", "umi AS umi_count").cache()
    rows.count()
    out = []
    records, _ = shuffled(spark, lambda: out.extend(direct.match_cells(rows, rows, config.DirectParams(hamming_threshold=0, jaccard_threshold=0.99)).where("T0_cell_barcode = T1_cell_barcode").collect()))
    assert len(out) > n * 0.9 and records < 1_000_000  # each of the 2 million pairs shares several barcodes


def test_clones_of_one_family_are_ranked_without_rows_for_pairs(spark):
    n = 1500
    rows = sharing(spark, n).select(F.col("id").alias("clone_id"), "barcode").cache()
    rows.count()
    out = []
    records, _ = shuffled(spark, lambda: out.extend(timepoints.match_clones(rows, rows, config.TimepointParams(hamming_threshold=0, top_n=1)).collect()))
    assert len(out) == n and all(r.similarity_score == 1.0 for r in out) and records < 1_000_000


def test_degrees_of_one_family_need_no_bitmap_a_cell_and_barcode(spark):
    n = 6000
    rows = sharing(spark, n).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("cell"), "barcode").cache()
    rows.count()
    out = []
    _, size = shuffled(spark, lambda: out.append(clones.clone_groups(rows, p=config.CloneParams(hamming_threshold=0)).agg(F.count("*").alias("n"), F.max("degree").alias("most")).first()))
    assert out[0].n == n and n * 0.9 < out[0].most < n and size < 60_000_000


def test_queries_that_show_no_degree_count_none(spark, monkeypatch):
    from cladeworks.plans import queries

    monkeypatch.setattr(clones, "_class_degrees", lambda *_: pytest.fail("degrees were counted"))
    assert queries.clone_barcodes(spark, "/root/testdata/sf0.001").count() > 0
