"""Hand-computed cases, one for each rule that is easy to get wrong."""

import math
import random

import numpy as np

import pytest
from pyspark.sql import functions as F

from cladeworks import config, runtime
from cladeworks.functions import sequences, statistics
from cladeworks.operators import clones, cluster, components, direct, enrichment, molecules, noise, qc, similarity, timepoints

CORRECTED = "cell_barcode string, corrected_lineage_barcode string, umi_count long, total_molecules_per_cell long, total_lineages_per_cell long"


def counts(spark, rows):
    return molecules.with_totals(spark.createDataFrame(rows, "cell_barcode string, corrected_lineage_barcode string, umi_count long"))


def test_wsn(spark):
    df = spark.createDataFrame([("AGCTCA", 0), ("CGAATA", 2), ("NGA", 1), ("", 0)], "s string, n int")
    assert all(r.m == r.n for r in df.withColumn("m", sequences.wsn_mismatches(F.col("s"))).collect())


def test_hamming_lengths(spark):
    df = spark.createDataFrame([("AC", "ACG", 3), ("A", "AC", 2), ("AC", "AG", 1), ("", "", 0)], "a string, b string, n int")
    assert all(r.d == r.n for r in df.withColumn("d", sequences.hamming(F.col("a"), F.col("b"))).collect())
    with pytest.raises(Exception, match="length"):
        df.select(sequences.strict_hamming(F.col("a"), F.col("b"))).collect()


def test_confidence(spark):
    c = sequences.match_confidence(F.lit(10.0), F.lit(5.0), F.lit(1.0), F.lit(2.0))
    assert spark.range(1).select(c.alias("c")).first().c == pytest.approx(0.5)


def test_extraction(spark):
    capture = "GGTT"
    one = spark.createDataFrame([(0, "I:R:F:1", "A" * 16 + "C" * 12 + "TT"), (1, "I:R:F:2", "G" * 28), (2, "I:R:F:9", "T" * 28)], "ord long, id string, seq string")
    two = spark.createDataFrame([(0, "I:R:F:1 x", "TTAGCTCAGGTTA"), (1, "I:R:F:2", "AGGGTTAAAAAAA"), (2, "I:R:F:3", "AGCTCAGGTT"), (3, "I:R:F:4", "AAAA")], "ord long, id string, seq string")
    rows = molecules.extract_addresses(one, two, "I:R:F:", capture, 6).collect()
    assert [tuple(r) for r in rows] == [("1", "A" * 16, "C" * 12, "AGCTCA", 0)]
    c = molecules.extraction_counters(one, two, "I:R:F:", capture, 6).first()
    assert (c.reads, c.with_capture, c.with_barcode, c.emitted, c.unpaired) == (4, 3, 2, 1, 1)


def test_filters_are_strict(spark):
    m = spark.createDataFrame([("F", "u", "L", 1), ("F", "v", "L", 2), ("X", "u", "L", 9)], "cell_barcode string, umi string, lineage_barcode string, read_count long")
    w = spark.createDataFrame([("G1", "F", 1), ("G2", "F", 2)], "cell_barcode_gex string, cell_barcode_feature string, line int")
    allowed = spark.createDataFrame([("G2",)], "cell_barcode_gex string")
    assert [tuple(r) for r in molecules.translate_cells(m, w, allowed, 1, "line").collect()] == [("G2", "v", "L", 2)]


def test_umi_counted_per_lineage(spark):
    m = spark.createDataFrame([("c", "U", "L1", 1), ("c", "U", "L2", 1)], "cell_barcode string, umi string, lineage_barcode string, read_count long")
    assert {r.total_unique_umis for r in molecules.umi_counts(m).collect()} == {2}


def test_collapse_family(spark):
    family = "ACGTACGTACGTACG"
    rows = [(family + "A", "C" * 11 + "T", f"L{i}", 1) for i in range(20)] + [(family + "C", "C" * 11 + "T", f"L{i}", 1) for i in range(3)]
    rows += [(family + "G", "C" * 11 + "TA"[i % 2], f"L{i}", 1) for i in range(30)] + [("N" * 16, "T" * 12, "L", 1)]
    m = spark.createDataFrame(rows, "cell_barcode string, umi string, lineage_barcode string, read_count long")
    assert {r.bc_old for r in molecules.altered_barcodes(m, "10xv3").collect()} == {family + "A", family + "C"}
    out = molecules.collapse_barcodes(m, "10xv3").groupBy("cell_barcode").count().collect()
    assert {r.cell_barcode: r["count"] for r in out} == {family: 23, family + "G": 30}
    assert molecules.collapse_barcodes(m, "10xv3").where(F.col("cell_barcode") == family).select("umi").distinct().count() == 2
    fewer = m.where(~((F.col("cell_barcode") == family + "A") & (F.col("lineage_barcode") == "L0")))
    assert molecules.altered_barcodes(fewer, "10xv3").count() == 0


def test_noise_rules(spark):
    level = [("lone", f"L{i}", 10) for i in range(5)]
    small = [("few", f"M{i}", 10) for i in range(4)]
    stats = {(r.cell_barcode, r.corrected_lineage_barcode): r for r in noise.noise_statistics(counts(spark, level + small)).collect()}
    assert stats["lone", "L0"].z_score == 0.0 and stats["few", "M0"].z_score is None
    assert {r.cell_barcode for r in noise.filter_noise(counts(spark, level + small)).collect()} == {"lone"}


def test_blocked_join_is_complete(spark):
    rnd = random.Random(5)
    seqs = ["".join(rnd.choice("ACGT") for _ in range(n)) for n in (0, 1, 1, 2, 3) * 6 + (8,) * 60 + (9,) * 30]
    left, right = seqs[::2], seqs[1::2]
    for d in (0, 1, 2, 3):
        for strict in (False, True):
            got = similarity.hamming_pairs(spark.createDataFrame([(x,) for x in left], "b string"), spark.createDataFrame([(x,) for x in right], "b string"), d, strict)
            dist = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True)) if len(a) == len(b) else max(len(a), len(b))
            want = {(a, b, dist(a, b)) for a in left for b in right if dist(a, b) <= d and (not strict or len(a) == len(b))}
            rows = [tuple(r) for r in got.collect()]
            assert len(rows) == len(set(rows)) and set(rows) == want


@pytest.mark.parametrize("r", [1, 2, 3, 4])
def test_choices_of_segments_are_complete(spark, monkeypatch, r):
    """Whatever the number of segments chosen, also with more of them than letters."""
    monkeypatch.setattr(similarity, "segments_chosen", lambda a, b, d: r)
    rnd = random.Random(r)
    seqs = sorted({"".join(rnd.choice("AC") for _ in range(n)) for n in (3, 4, 5, 8) * 12})
    df = spark.createDataFrame([(x,) for x in seqs], "b string")
    dist = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True))
    for d in (1, 2):
        rows = [tuple(x) for x in similarity.hamming_pairs(df, df, d, True).collect()]
        assert len(rows) == len(set(rows)) and set(rows) == {(a, b, dist(a, b)) for a in seqs for b in seqs if len(a) == len(b) and dist(a, b) <= d}


def test_dense_barcodes_choose_longer_keys(spark):
    rnd = random.Random(1)
    make = lambda n, size: spark.createDataFrame([("".join(rnd.choice("ACGT") for _ in range(size)),) for _ in range(n)], "b string").distinct()
    dense, sparse = make(2000, 8).cache(), make(500, 24).cache()
    one, two = dense.toDF("b1"), dense.toDF("b2")
    found = similarity.candidates(one, two, 2, [1, 2, 3, 4])
    r = similarity.segments_chosen(one, two, 2)
    assert r > 1 and 20 * found[r][0] < dense.count() ** 2 and 3 * found[r][0] < found[1][0]
    assert similarity.segments_chosen(sparse.toDF("b1"), sparse.toDF("b2"), 2) == 1
    held = similarity._keys(one, "b1", 2, 2).join(similarity._keys(two, "b2", 2, 2), ["len", "at", "key"]).count()
    assert held == found[2][0], "the count is of the pairs that are made"


def prepared(spark, cells):
    rows = [(c, b, u, len(bs)) for c, bs in cells.items() for b, u in bs.items()]
    df = spark.createDataFrame(rows, "cell_barcode string, corrected_lineage_barcode string, umi_count long, lineage_count long")
    return clones.prepare_cells(df, "s")


def test_quick_mode(spark):
    x, y, y2 = "A" * 8, "C" * 8, "C" * 7 + "G"
    one = prepared(spark, {"c1": {x: 5, y: 4}, "c2": {x: 5, y2: 4}})
    quick = clones.clone_pairs(one).first()
    assert (quick.num_exact_matches, quick.num_hamming_matches, quick.num_barcode_comparisons) == (1, 0, 1)
    full = clones.clone_pairs(one, p=config.CloneParams(quick_mode=False)).first()
    assert (full.num_exact_matches, full.num_hamming_matches, full.num_barcode_comparisons) == (1, 1, 4)
    both = clones.clone_pairs(one, p=config.CloneParams(force_hamming_all=True)).first()
    assert (both.num_exact_matches, both.num_hamming_matches, both.num_barcode_comparisons) == (2, 1, 5)
    assert quick.matched_barcode_pairs == f"{x}|{x}|d:0|c:1.0000|u1:5|u2:5|r1:1|r2:1"


def test_all_pairs_hold_misses(spark):
    one = prepared(spark, {"a": {"A" * 8: 1}, "b": {"A" * 8: 1}, "c": {"G" * 8: 1}})
    rows = {(r.cell_barcode_1, r.cell_barcode_2): r for r in clones.all_pairs(one).collect()}
    assert len(rows) == 3 and rows["a", "b"].is_clone and rows["a", "c"].min_observed_distance == 8 and rows["a", "c"].best_hamming_distance is None


def test_components_chain(spark):
    one = prepared(spark, {"a": {"AAAAAAAA": 1}, "b": {"AAAAAACC": 1}, "c": {"AAAACCCC": 1}, "d": {"GGGGGGGG": 1}})
    groups = clones.clone_groups(one).collect()
    assert {r.cell_barcode: (r.cloneID, r.clone_size, r.degree) for r in groups} == {"a": (1, 3, 1), "b": (1, 3, 2), "c": (1, 3, 1), "d": (2, 1, 0)}


@pytest.mark.parametrize("listed", [64, 1])
def test_groups_match_pairs(spark, monkeypatch, listed):
    monkeypatch.setattr(clones, "LISTED_OWNERS", listed)  # beyond it degrees come from bitmaps
    rnd = random.Random(7)
    pool = ["".join(rnd.choice("AC") for _ in range(7)) for _ in range(30)]
    make = lambda source, n: clones.prepare_cells(spark.createDataFrame([(f"{source}{i}", b, 1, 3) for i in range(n) for b in set(rnd.choices(pool, k=rnd.randrange(1, 3)))], "cell_barcode string, corrected_lineage_barcode string, umi_count long, lineage_count long"), source)
    one, two = make("x", 40).cache(), make("y", 30).cache()
    for other in (None, two):
        for d in (0, 1):
            p = config.CloneParams(hamming_threshold=d)
            pairs = [((r.source_condition_1, r.cell_barcode_1), (r.source_condition_2, r.cell_barcode_2)) for r in clones.clone_pairs(one, other, p).collect()]
            cells = {(r.source, r.cell) for x in (one, other) if x is not None for r in x.collect()}
            group = {c: c for c in cells}

            def find(x, group=group):
                while group[x] != x:
                    x = group[x]
                return x

            for a, b in pairs:
                a, b = find(a), find(b)
                group[max(a, b)] = min(a, b)
            got = clones.clone_groups(one, other, p).collect()
            assert {(r.source_condition, r.cell_barcode) for r in got} == cells
            assert {(r.source_condition, r.cell_barcode): r.degree for r in got} == {c: sum(c in x for x in pairs) for c in cells}
            numbers = {}
            for r in got:
                numbers.setdefault(r.cloneID, set()).add(find((r.source_condition, r.cell_barcode)))
            assert all(len(x) == 1 for x in numbers.values()) and len(numbers) == len({find(c) for c in cells})


def test_a_common_lineage_lists_no_pairs(spark):
    n = 100_000
    rows = spark.range(n).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("cell"), F.lit("ACGTACGT").alias("barcode"), F.lit(1.0).alias("umi"), F.lit(1.0).alias("rank"), F.lit(1).alias("barcodes"))
    out = clones.clone_groups(rows).agg(F.countDistinct("cloneID").alias("clones"), F.min("clone_size").alias("size"), F.max("degree").alias("degree")).first()
    assert (out.clones, out.size, out.degree) == (1, n, n - 1)


def test_a_common_lineage_beside_own_ones_lists_no_pairs(spark):
    """All cells share one barcode and each has another of its own; a thousand pairs also share a rare one."""
    n = 100_000
    own = "concat_ws('', transform(sequence(0, 8), i -> repeat(substr('ACGT', cast(shiftright(id, 2 * i) & 3 as int) + 1, 1), 2)))"
    rare = "concat('TTTTTTTTTTTT', concat_ws('', transform(sequence(0, 5), i -> repeat(substr('ACGT', cast(shiftright(id % 1000, 2 * i) & 3 as int) + 1, 1), 2))))"
    rows = spark.range(n).selectExpr("'s' AS source", "cast(id as string) AS cell", f"explode(filter(array('GGGGGGGGGGGGGGGGGGGGGGGG', {own}, if(id < 2000, {rare}, null)), x -> x is not null)) AS barcode", "1.0D AS umi", "1.0D AS rank", "2L AS barcodes")
    out = clones.clone_groups(rows, p=config.CloneParams(hamming_threshold=0)).agg(F.countDistinct("cloneID").alias("clones"), F.min("degree").alias("least"), F.max("degree").alias("most")).first()
    assert (out.clones, out.least, out.most) == (1, n - 1, n - 1)


def test_components_match_union_find(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rnd.randrange(60), 100 + rnd.randrange(60)) for _ in range(40)] + [(7, 7), (500, 500)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = components.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in parent}
    assert components.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_timepoint_similarity_can_exceed_one(spark):
    t1 = spark.createDataFrame([(1, "AAAA"), (1, "AAAC")], "clone_id long, barcode string")
    t0 = spark.createDataFrame([(9, "AAAA")], "clone_id long, barcode string")
    row = timepoints.match_clones(t0, t1, config.TimepointParams(hamming_threshold=1)).first()
    assert (row.num_matched_barcodes, row.similarity_score) == (2, 2.0)


def test_unmatched_and_grid(spark):
    t1 = spark.createDataFrame([(1, "AAAA"), (2, "CCCC"), (2, "GGGG"), (2, "TTTT"), (3, "ACAC")], "clone_id long, barcode string")
    t0 = spark.createDataFrame([(9, "AAAA"), (8, "CCCC")], "clone_id long, barcode string")
    ranked = timepoints.match_clones(t0, t1, config.TimepointParams(hamming_threshold=0))
    assert sorted((r[0], r[1], round(r[2], 3)) for r in timepoints.unmatched_clones(ranked, t1).collect() if r[1]) == [(2, 8, 0.333)]
    assert {r[0] for r in timepoints.unmatched_clones(ranked, t1).collect()} == {2, 3}
    assert {tuple(r) for r in timepoints.top_match_grid(ranked).select("T1_clone_id", "8", "9").collect()} == {(1, 0.0, 1.0), (2, 1 / 3, 0.0)}


@pytest.mark.parametrize(("common", "top"), [(64, 2), (3, 2), (1, 1), (1, 3), (0, 4)])
def test_best_clones_match_brute_force(spark, monkeypatch, common, top):
    """Whatever number of owners makes a barcode a common one."""
    monkeypatch.setattr(timepoints, "COMMON_OWNERS", common)
    rnd = random.Random(common * 10 + top)
    pool = sorted({"".join(rnd.choice("AC") for _ in range(7)) for _ in range(40)})
    weight = lambda i: 1 / (1 + i) ** 1.2
    make = lambda n: {i: sorted({*rnd.choices(pool, [weight(k) for k in range(len(pool))], k=rnd.randrange(1, 6)), *(pool[:1] if rnd.random() < 0.7 else [])}) for i in range(n)}
    t0, t1 = make(25), make(25)
    near = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    want = set()
    for c1, s1 in t1.items():
        scores = []
        for c0, s0 in t0.items():
            m = sum(any(near(a, b) for b in s0) for a in s1)
            if m:
                scores.append((-m / (len(s1) + len(s0) - m), c0, m))
        want |= {(c1, c0, round(-s, 9), m, rank) for rank, (s, c0, m) in enumerate(sorted(scores)[:top], 1)}
    df = lambda x: spark.createDataFrame([(c, b) for c, bs in x.items() for b in bs], "clone_id long, barcode string")
    got = timepoints.match_clones(df(t0), df(t1), config.TimepointParams(hamming_threshold=1, top_n=top)).collect()
    assert {(r.T1_clone_id, r.T0_clone_id, round(r.similarity_score, 9), r.num_matched_barcodes, r.match_rank) for r in got} == want and len(got) == len(want)


def test_a_barcode_of_all_clones_meets_no_pairs(spark):
    """20,000 clones a side share one barcode, half of them have one of their own besides: 400 million pairs are not made."""
    n = 20_000
    own = "concat_ws('', transform(sequence(0, 7), i -> repeat(substr('ACGT', cast(shiftright(id, 2 * i) & 3 as int) + 1, 1), 2)))"
    clones_ = lambda k: spark.range(n).selectExpr("id AS clone_id", f"explode(if(id % 2 = {k}, array('GGGGGGGGGGGGGGGGTT', {own}), array('GGGGGGGGGGGGGGGGTT'))) AS barcode")
    p = config.TimepointParams(hamming_threshold=0, top_n=2)
    rows = timepoints.match_clones(clones_(0), clones_(1), p).where("match_rank <= 2").groupBy("T0_clone_id", "similarity_score", "match_rank").count().collect()
    # T0 clones with the one barcode alone are those of odd id; the least of them are everyone's best.
    assert {tuple(r) for r in rows} == {(1, 1.0, 1, n // 2), (3, 1.0, 2, n // 2), (1, 0.5, 1, n // 2), (3, 0.5, 2, n // 2)}


def test_direct_is_one_to_one(spark):
    t1 = counts(spark, [("n", "AAAA", 3), ("n", "AAAC", 2), ("m", "GGGG", 1)])
    t0 = counts(spark, [("o", "AAAA", 1)])
    rows = {r.T1_cell_barcode: r for r in direct.match_cells(t0, t1, config.DirectParams(hamming_threshold=1, jaccard_threshold=0.1, min_matched_barcodes=1)).collect()}
    assert (rows["n"].matched_barcodes, rows["n"].jaccard_similarity) == (1, 0.5)
    assert rows["m"].T0_cell_barcode == direct.NO_MATCH and rows["m"].match_rank == 1


def test_direct_matches_brute_force(spark):
    rnd = random.Random(11)
    pool = ["".join(rnd.choice("AC") for _ in range(6)) for _ in range(14)]
    make = lambda name: [(f"{name}{i}", b, rnd.randrange(1, 9)) for i in range(8) for b in rnd.sample(sorted(set(pool)), 4)]
    old, new = make("o"), make("n")
    for p in (config.DirectParams(jaccard_threshold=0.4), config.DirectParams(jaccard_threshold=0.2, use_umi_weighting=True, top_n=2, hamming_threshold=1)):
        cells = lambda rows: {c: {b: u for d, b, u in rows if d == c} for c, _, _ in rows}
        want = set()
        for c1, s1 in cells(new).items():
            found = []
            for c0, s0 in cells(old).items():
                edges = sorted((sum(x != y for x, y in zip(a, b, strict=True)), a, b) for a in s1 for b in s0)
                used1, used0, taken = set(), set(), []
                for d, a, b in edges:
                    if d <= p.hamming_threshold and a not in used1 and b not in used0:
                        used1.add(a)
                        used0.add(b)
                        taken.append((d, a, b))
                if len(taken) < p.min_matched_barcodes:
                    continue
                jaccard = len(taken) / (len(s0) + len(s1) - len(taken))
                shared = sum(min(s1[a], s0[b]) for _, a, b in taken)
                score = shared / (sum(s0.values()) + sum(s1.values()) - shared) if p.use_umi_weighting else jaccard
                if score >= p.jaccard_threshold:
                    found.append((-score, -len(taken), sum(t[0] for t in taken) / len(taken), c0, round(jaccard, 6)))
            found = sorted(found)[: p.top_n or None]
            want |= {(c1, c0, -n, j, i) for i, (_, n, _, c0, j) in enumerate(found, 1)} or {(c1, direct.NO_MATCH, 0, 0.0, 1)}
        got = direct.match_cells(counts(spark, old), counts(spark, new), p).collect()
        assert {(r.T1_cell_barcode, r.T0_cell_barcode, r.matched_barcodes, r.jaccard_similarity, r.match_rank) for r in got} == want


def test_parameters_are_checked(spark):
    with pytest.raises(ValueError):
        config.DirectParams(jaccard_threshold=1.5)
    with pytest.raises(ValueError, match="missing"):
        direct.validate_counts(spark.createDataFrame([("c",)], "cell_barcode string"))
    with pytest.raises(ValueError, match="1 of 2"):
        direct.validate_counts(spark.createDataFrame([("c", "b", "1"), ("c", "d", "-2")], "cell_barcode string, corrected_lineage_barcode string, umi_count string"))


def test_fisher_and_fold(spark):
    rnd = random.Random(1)
    tables = sorted({tuple(rnd.randrange(1, rnd.choice((4, 40, 400))) for _ in range(4)) for _ in range(300)} | {(11, 6, 11, 31), (1, 1, 1, 1), (0, 5, 5, 0), (0, 0, 0, 0), (0, 7, 0, 3), (31, 32, 33, 34)})
    want = {}
    for a, b, c, d in tables:
        row, col, n = a + b, a + c, a + b + c + d
        chance = {x: math.comb(row, x) * math.comb(n - row, col - x) for x in range(max(0, col - c - d), min(row, col) + 1)}
        want[a, b, c, d] = sum(v for v in chance.values() if v <= chance[a] * statistics.NEAR) / math.comb(n, col)
    df = spark.createDataFrame([(i, *t) for i, t in enumerate([*tables, *tables[:5]])], "i int, a long, b long, c long, d long")
    got = statistics.with_fisher_p(df, *map(F.col, "abcd"), "p")
    rows = got.collect()
    assert got.columns == ["i", "a", "b", "c", "d", "p"] and sorted(r.i for r in rows) == list(range(len(tables) + 5))
    for r in rows:
        assert r.p == pytest.approx(want[r.a, r.b, r.c, r.d], rel=1e-9), r
    assert want[11, 6, 11, 31] == pytest.approx(0.008131176, abs=1e-9)
    large = spark.createDataFrame([(10**9, 10**9 + 10**5, 10**9, 10**9), (10**6, 10**6, 10**6, 2 * 10**6)], "a long, b long, c long, d long")
    assert {r.a: r.p for r in statistics.fisher_tables(large).collect()} == pytest.approx({10**9: 0.1138, 10**6: 0.0}, abs=1e-3)
    size = lambda n: spark.createDataFrame([(1, n)], "clone_id long, size long")
    row = enrichment.run_enrichment(size(9), size(4), size(19)).first()
    assert (row.FC_control, row.FC_treated, row.Log2_FC_ratio) == (0.5, 2.0, 2.0)


def test_log_factorials(spark):
    ks = [*range(200), 1000, 12345, 10**6, 10**9, 10**12]
    got = spark.createDataFrame([(k,) for k in ks], "k long").select("k", statistics.log_factorial(F.col("k")).alias("v")).collect()
    assert all(r.v == pytest.approx(math.lgamma(r.k + 1), rel=1e-13, abs=1e-13) for r in got)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 200, 201])
def test_exact_median(spark, n):
    rnd = random.Random(n)
    values = [rnd.choice((rnd.random(), 0.5, -3.0, float(rnd.randrange(4)))) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in [*values, None, None]], "v double").repartition(5)
    want = float(np.median(values)) if n else None
    assert statistics.exact_median(df, "v") == want
    assert df.agg(F.median("v")).first()[0] == want


def test_benjamini_hochberg(spark):
    df = spark.createDataFrame([(p,) for p in (0.01, 0.02, 0.03)], "p double")
    assert [round(r.q, 9) for r in statistics.benjamini_hochberg(df, "p", "q").collect()] == [0.03] * 3
    rnd = random.Random(3)
    p = [rnd.choice((0.001, 0.04, 0.5, 1.0, rnd.random())) for _ in range(200)]
    order = sorted(p)
    least = [min(1.0, *(x * len(p) / i for i, x in enumerate(order, 1) if x >= v)) for v in p]
    got = statistics.benjamini_hochberg(spark.createDataFrame(list(enumerate(p)), "i int, p double"), "p", "q").orderBy("i").collect()
    assert [r.q for r in got] == pytest.approx(least)
    assert statistics.benjamini_hochberg(df.limit(0), "p", "q").count() == 0


def test_numbered(spark):
    rows = [(x * 7919 % 1000, x % 3) for x in range(1000)]
    got = runtime.numbered(spark.createDataFrame(rows, "a int, b int").repartition(5), "n", F.desc("b"), F.col("a")).collect()
    assert {(r.a, r.b): r.n for r in got} == {r: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1)}


def test_poisson():
    rate = 1.7
    assert statistics.truncated_rate(rate / -math.expm1(-rate)) == pytest.approx(rate)
    assert statistics.truncated_rate(1.0) == 0.0
    fit = statistics.fit_truncated_poisson({1: 50, 2: 20, 5: 3})
    assert len(fit.expected) == 3 and 0 <= fit.p_value <= 1
    # Two samples of 3 that do not overlap: 2 of the 20 ways are as extreme.
    assert statistics.ks_equal_sizes([1, 2, 3], [4, 5, 6]) == (1.0, pytest.approx(0.1))


def test_clusters(spark):
    rows = [("c", "AAAAAA", 50), ("c", "AAAAAC", 5), ("c", "AAAACC", 1), ("c", "AAAAG", 30), ("c", "TTTTTT", 2), ("d", "AAAAAC", 5)]
    df = spark.createDataFrame(rows, "cellbc string, lineage_barcode string, unique_umi_count long")
    got = {(r.cell_barcode, r.sequence_in_cluster): r.canonical_sequence for r in cluster.cluster_lineages(df, 1).collect()}
    assert got == {("c", "AAAAAA"): "AAAAAA", ("c", "AAAAAC"): "AAAAAA", ("c", "AAAACC"): "AAAAAA", ("c", "AAAAG"): "AAAAG", ("c", "TTTTTT"): "TTTTTT", ("d", "AAAAAC"): "AAAAAC"}


def test_neighbours_by_segments(spark):
    rnd = random.Random(4)
    seqs = {"".join(rnd.choice("AC") for _ in range(rnd.randrange(0, 9))) for _ in range(60)}
    rows = [(c, s, rnd.randrange(1, 9)) for c in "xy" for s in seqs]
    n = {(c, s): k for c, s, k in rows}

    def edits(a, b):
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            last = row
        return last[-1]

    df = spark.createDataFrame(rows, "cellbc string, lineage_barcode string, unique_umi_count long")
    for d in (1, 2, 3):
        want = {(c, a, b) for c in "xy" for a in seqs for b in seqs if a != b and edits(a, b) <= d and (n[c, b] > n[c, a] or n[c, b] == n[c, a] and b < a)}
        got = [(r.cell, r.child, r.parent) for r in cluster.neighbour_pairs(df, d).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_retention(spark):
    row = spark.range(1).select(qc.retention(F.lit(0), F.lit(0)).alias("none"), qc.retention(F.lit(4), F.lit(1)).alias("some")).first()
    assert (row.none, row.some) == (0.0, 25.0)
