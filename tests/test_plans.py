"""Files, the pipeline from reads to clones, and streaming counts."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from cladeworks.__main__ import main
from cladeworks.config import CAPTURE_SEQUENCE, DirectParams, NoiseParams
from cladeworks.operators import clones, cluster, molecules
from cladeworks.plans.pipeline import STEPS, Inputs, Pipeline, PipelineParams, retention_report
from cladeworks.sources import tables
from cladeworks.streaming import addresses


def fastq(path, rows, zipped=True):
    text = "".join(f"@{i}\n{s}\n+\n{'I' * len(s)}\n" for i, s in rows)
    (gzip.open if zipped else open)(path, "wt").write(text)


@pytest.fixture
def reads(tmp_path):
    rnd = random.Random(3)
    bases = lambda n, kinds="ACGT": "".join(rnd.choice(kinds) for _ in range(n))
    wsn = lambda: "".join(rnd.choice("AT") + rnd.choice("GC") + rnd.choice("ACGT") for _ in range(28))
    cells, lines = [bases(16, "ACT") for _ in range(4)], [wsn() for _ in range(6)]
    one, two = [], []
    for i in range(400):
        c = rnd.randrange(4)
        one.append((f"I:R:F:{i} 1", cells[c] + bases(12)))
        two.append((f"I:R:F:{i} 2", "AC" + lines[(c // 2 * 3 + rnd.randrange(3)) % 6] + CAPTURE_SEQUENCE + "AA"))
    fastq(tmp_path / "r1.fastq.gz", one)
    fastq(tmp_path / "r2.fastq.gz", two)
    fastq(tmp_path / "r2.fastq", two, zipped=False)
    return tmp_path, cells


def test_fastq(spark, reads):
    folder, _ = reads
    a, b = (tables.read_fastq(spark, str(folder / n)).orderBy("ord").collect() for n in ("r2.fastq.gz", "r2.fastq"))
    assert a == b and len(a) == 400 and a[17].id == "I:R:F:17 2"


@pytest.mark.parametrize("block", [37, 64, 211, 1000])
def test_fastq_over_many_blocks(spark, tmp_path, block):
    """Records that blocks tear at every line, files of a folder in the order of their names, long ids, a cut-off last record."""
    rnd = random.Random(block)
    want = []
    for name in ("b", "a", "c"):
        rows = [(f"{name}{i} " + "y" * rnd.randrange(30), "ACGT"[i % 4] * rnd.randrange(1, 90)) for i in range(60)]
        fastq(tmp_path / f"{name}.fastq", rows, zipped=False)
        want.append((name, rows))
    want = [r for _, rows in sorted(want) for r in rows] + [("cut", "AC")]
    with open(tmp_path / "c.fastq", "a") as out:
        out.write("@cut\nAC\n")
    conf = {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": "1"}
    held = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert [tuple(r) for r in tables.read_fastq(spark, str(tmp_path)).orderBy("ord").collect()] == [(i, *r) for i, r in enumerate(want)]
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_fastq_ids_are_whole(spark, tmp_path):
    fastq(tmp_path / "x.fastq", [("i" * 1_100_000, "A" * 50), ("j", "C")], zipped=False)
    assert [(len(r.id), r.seq) for r in tables.read_fastq(spark, str(tmp_path / "x.fastq")).orderBy("ord").collect()] == [(1_100_000, "A" * 50), (1, "C")]


def test_reads_take_one_exchange(spark, reads):
    folder, _ = reads
    mates = [tables.read_fastq(spark, str(folder / "r2.fastq")) for _ in range(2)]
    plan = molecules.extract_addresses(*mates, "I:R:F:")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_whitelist_lines_overrule_by_file_name(spark, tmp_path):
    """Files of falling size: the last one by name counts, whichever is read first."""
    for name, lines in (("a.tsv", 400), ("b.tsv", 40), ("c.tsv", 1)):
        (tmp_path / name).write_text("".join(f"{name}{i}\tx{i}\n" for i in range(lines)))
    rows = tables.read_whitelist(spark, str(tmp_path))
    last = {r.cell_barcode_feature: r.g for r in rows.groupBy("cell_barcode_feature").agg(F.max_by("cell_barcode_gex", "line").alias("g")).collect()}
    assert last["x0"] == "c.tsv0" and last["x1"] == "b.tsv1" and last["x39"] == "b.tsv39" and last["x40"] == "a.tsv40" and len(last) == 400


def test_rejects_have_lines_and_reasons(spark, tmp_path):
    head = "cell_barcode\tcorrected_lineage_barcode\tumi_count\n"
    (tmp_path / "a.tsv").write_text(head + "".join(f"c{i}\tb\t1\n" for i in range(300)))
    (tmp_path / "b.tsv").write_text(head + "".join(f"d{i}\tb\t{i}\n" for i in range(40)))
    assert tables.read_counts(spark, str(tmp_path)).count() == 340
    (tmp_path / "c.tsv").write_text(head + "c\tb\t2\n\tb\t1\nc\t\t1\nc\tb\tx\nc\tb\t-1\nc\tb\n")
    got = [(r.line, r.reason) for r in tables.count_rejects(spark, str(tmp_path)).orderBy("file", "line").collect()]
    assert got == [(3, "no cell barcode"), (4, "no lineage barcode"), (5, "count is not a whole number"), (6, "count is negative"), (7, "2 fields instead of 3")]
    with pytest.raises(ValueError, match="5 lines .*c.tsv, line 3: no cell barcode"):
        tables.read_counts(spark, str(tmp_path))
    (tmp_path / "d.tsv").write_text("cell_barcode\tx\n")
    with pytest.raises(ValueError, match="missing columns: corrected_lineage_barcode, umi_count"):
        tables.read_counts(spark, str(tmp_path / "d.tsv"))
    (tmp_path / "e.tsv").write_text(head)
    with pytest.raises(ValueError, match="no counts"):
        tables.read_counts(spark, str(tmp_path / "e.tsv"))


def test_pipeline_and_resume(spark, reads):
    folder, cells = reads
    white = spark.createDataFrame([(c[::-1], c) for c in cells], "cell_barcode_gex string, cell_barcode_feature string")
    allowed = white.select("cell_barcode_gex")
    inputs = Inputs(tables.read_fastq(spark, str(folder / "r1.fastq.gz")), tables.read_fastq(spark, str(folder / "r2.fastq.gz")), white, allowed)
    p = PipelineParams(prefix="I:R:F:", min_reads=0, max_distance=1, noise=NoiseParams(min_group_size=1, z_threshold=9))
    run = Pipeline(spark, str(folder / "out"), inputs, p)
    out = run.run()
    assert out["addresses"].count() == 400 and out["corrected"].select("cell_barcode").distinct().count() == 4
    assert sorted(r.clone_size for r in out["clones"].collect()) == [2, 2, 2, 2]
    steps = {x["step"]: x.get("counts") for x in json.loads(run.run_log())["steps"]}
    assert steps["addresses"] == {"reads": 400, "with_capture": 400, "with_barcode": 400, "emitted": 400, "with_mismatches": 0, "unpaired": 0}
    assert all(steps[x]["rows"] == out[x].count() for x in ("filtered_addresses", "molecules", "translated")) and steps["corrected"] is None
    assert [r.rows for r in retention_report(run).collect()] == sorted((r.rows for r in retention_report(run).collect()), reverse=True)
    again = Pipeline(spark, str(folder / "out"), inputs, p).run(10, 10)
    assert again["clones"].count() == 4 and json.loads(run.run_log())["steps"][0]["step"] == STEPS[0]
    own = again["clones"].select("cloneID", "clone_barcode").distinct()
    own = spark.createDataFrame(own.collect(), own.schema)
    both = Inputs(inputs.read1, inputs.read2, white, allowed, own, None, own, None)
    last = Pipeline(spark, str(folder / "out"), both, p).run(11, 12)
    assert {r.similarity_score for r in last["matches"].where("match_rank = 1").collect()} == {1.0}
    assert {r.Status for r in last["enrichment"].collect()} == {"Neutral"}
    with pytest.raises(ValueError):
        run.run(3, 2)
    with pytest.raises(ValueError, match="t0_counts"):
        run.run(13, 13)
    both.t0_counts = spark.createDataFrame(out["corrected"].collect(), out["corrected"].schema)
    more = Pipeline(spark, str(folder / "out"), both, PipelineParams(prefix="I:R:F:", noise=p.noise, direct=DirectParams(min_matched_barcodes=1))).run(13, 14)
    assert {r.jaccard_similarity for r in more["direct_matches"].where("match_rank = 1").collect()} == {1.0}
    assert sorted(r.clone_size for r in more["cross_clones"].collect()) == [4] * 8


def test_clustering_resumes_between_buckets(spark, tmp_path, monkeypatch):
    """A run that dies after two of four buckets; the next does the other two only, and has the same rows. Other parameters start anew."""
    rnd = random.Random(9)
    rows = sorted({(f"c{rnd.randrange(30)}", "".join(rnd.choice("AC") for _ in range(8)), rnd.randrange(1, 40)) for _ in range(200)})
    spark.createDataFrame(rows, "cellbc string, lineage_barcode string, unique_umi_count long").groupBy("cellbc", "lineage_barcode").agg(F.max("unique_umi_count").alias("unique_umi_count")).write.parquet(str(tmp_path / "umi_counts"))
    p = PipelineParams(max_distance=1, cluster_buckets=4)
    make = lambda p=p, resume=True: Pipeline(spark, str(tmp_path), Inputs(), p, resume)
    seen, whole = [], cluster.cluster_lineages

    def dies(counts, distance, after=2):
        if len(seen) == after:
            raise RuntimeError("lost")
        seen.append(1)
        return whole(counts, distance)

    monkeypatch.setattr(cluster, "cluster_lineages", dies)
    with pytest.raises(RuntimeError):
        make().run(8, 8)
    with pytest.raises(ValueError, match="2 of 4 buckets"):
        make().table("corrections")
    monkeypatch.setattr(cluster, "cluster_lineages", lambda c, d: dies(c, d, 4))
    got = make().run(8, 8)["corrections"]
    want = whole(spark.read.parquet(str(tmp_path / "umi_counts")), 1)
    got = sorted(map(tuple, got.collect()))
    assert len(seen) == 4 and got == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError, match="4 of 4|2 of 2"):
        make(PipelineParams(max_distance=1, cluster_buckets=2)).table("corrections")
    monkeypatch.setattr(cluster, "cluster_lineages", lambda c, d: dies(c, d, 6))
    assert make(PipelineParams(max_distance=1, cluster_buckets=2)).run(8, 8)["corrections"].count() == len(got) and len(seen) == 6


def rows_of(spark, path, sep="\t"):
    return spark.read.option("sep", sep).option("header", True).csv(str(path)).collect()


def test_command_line(spark, reads):
    folder, cells = reads
    (folder / "w.tsv").write_text("".join(f"{c[::-1]}\t{c}\n" for c in cells))
    (folder / "a.tsv").write_text("".join(f"{c[::-1]}\n" for c in cells))
    at = lambda name: str(folder / name)
    noise = ["--min-group-size", "1", "--z-threshold", "9"]
    main(["pipeline", "--fastq1", at("r1.fastq.gz"), "--fastq2", at("r2.fastq.gz"), "--prefix", "I:R:F:", "--technology", "10xv3", "--whitelist", at("w.tsv"), "--allowed", at("a.tsv"), "--out", at("run"), "--min-reads", "0", "--max-distance", "1", *noise], spark)
    counts = [int(r.umi_count) for r in rows_of(spark, folder / "run/corrected.tsv")]
    assert counts == sorted(counts, reverse=True) and len(rows_of(spark, folder / "run/cloneID_cloneBarcode.tsv")) == 2 and len(rows_of(spark, folder / "run/retention.tsv")) == 3
    assert len(rows_of(spark, folder / "run/filtered.tsv")) > 0 and any("lineages" in r.value for r in spark.read.text(at("run/poisson.txt")).collect())
    main(["clones", "--counts", at("run/corrected.tsv"), "--all-pairs", "--out", at("c"), *noise], spark)
    assert len(rows_of(spark, folder / "c/clone_pairs.tsv")) == 6 and any("components" in r.value for r in spark.read.text(at("c/clone_statistics.txt")).collect())
    own = ["--t0-clones", at("c/cloneID_cloneBarcode.tsv")]
    main(["match-timepoints", *own, "--t1-clones", at("c/cloneID_cloneBarcode.tsv"), "--out", at("m")], spark)
    assert {r.similarity_score for r in rows_of(spark, folder / "m/best_matches.txt")} == {"1.0"}
    main(["direct", "--t0", at("run/corrected.tsv"), "--condition", f"Ctrl={at('run/corrected.tsv')}", "--out", at("d")], spark)
    assert {r.jaccard_similarity for r in rows_of(spark, folder / "d/T0_to_Ctrl_direct_matches.csv", ",") if r.match_rank == "1"} == {"1.000000"}
    main(["enrich", *own, "--control-clones", at("c/cloneID_cloneBarcode.tsv"), "--treated-clones", at("c/cloneID_cloneBarcode.tsv"), "--treated-matches", at("m/best_matches.txt"), "--out", at("e")], spark)
    assert len(rows_of(spark, folder / "e/differential_enrichment_results.txt")) == 2
    with pytest.raises(SystemExit):
        main(["match-timepoints", "--t0-clones", "x", "--t1-clones", "y", "--out", "z", "--similarity-threshold", "2"], spark)


def test_quality_commands(spark, reads):
    folder, _ = reads
    (folder / "addresses.txt").write_text("a u1 g1\na u2 g1\nb u1 g1\na u3 g2\n")
    main(["reads", "--original", str(folder / "r1.fastq.gz"), "--processed", str(folder / "addresses.txt"), "--out", str(folder / "q")], spark)
    text = {r.value.split()[0]: r.value.split()[-1] for r in spark.read.text(str(folder / "q/reads.txt")).collect() if r.value}
    assert (text["original"], text["processed"], text["percent"]) == ("400", "4", "1.0000")
    main(["cells", "--addresses", str(folder / "addresses.txt"), "--out", str(folder / "q")], spark)
    assert [tuple(r) for r in rows_of(spark, folder / "q/cumulative_histogram.tsv")] == [("a", "3", "0.750000"), ("b", "1", "1.000000")]
    assert [(r.genes, r.mean_molecules, r.mean_genes) for r in rows_of(spark, folder / "q/cell_curves.tsv")] == [("2", "3.0", "2.0"), ("1", "2.0", "1.5")]


def test_files(spark, tmp_path):
    path = lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)
    assert tables.read_addresses(spark, path("a", "r c u L 0\nbroken line\nr c u L 1 more\n")).count() == 1
    assert tables.read_addresses(spark, str(tmp_path / "a"), exact=False).count() == 2
    head = "cell_barcode\tcanonical_sequence\tsequence_in_cluster\n"
    assert tables.read_corrections(spark, path("c", head + "c\tA\tC\n")).count() == 1
    assert tables.read_allow_list(spark, path("l3", "NA\t5\t2\n")).first().cell_barcode_gex == "NA"
    with pytest.raises(ValueError, match="columns"):
        tables.read_allow_list(spark, path("l2", "a\tb\n"))
    good = "cell_barcode\tcorrected_lineage_barcode\tumi_count\nc\t001\t3\n"
    assert tables.read_counts(spark, path("k", good)).first().corrected_lineage_barcode == "001"
    with pytest.raises(ValueError):
        tables.read_counts(spark, path("bad", good + "c\tx\tmany\n"))
    df = spark.createDataFrame([("c", 1)], "a string, n long")
    tables.write_tsv(df, str(tmp_path / "t"), header=True, single=True)
    assert spark.read.text(str(tmp_path / "t")).count() == 2


def test_graph_document(spark, tmp_path):
    """Files joined by name are one document, over several files, with every node and link in order."""
    cells = {f"c{i:02}": ("AAAA" if i % 3 else "GGGG") for i in range(12)} | {"lone": "TTTT"}
    rows = [(c, b, 2, 1) for c, b in cells.items()]
    one = clones.prepare_cells(spark.createDataFrame(rows, "cell_barcode string, corrected_lineage_barcode string, umi_count long, lineage_count long"), "s").cache()
    groups, pairs = clones.clone_groups(one).cache(), clones.clone_pairs(one).cache()
    nodes, edges = clones.graph_nodes(groups), clones.graph_edges(pairs)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_graph(nodes, edges, str(tmp_path / "g"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "g").glob("part-*"))
    doc = json.loads("".join(p.read_text() for p in parts))
    held = {f"{r.source_condition}|{r.cell_barcode}": r for r in nodes.collect()}
    want = {"directed": False, "graph": {}, "nodes": [{"id": k, "source_condition": r.source_condition, "cell_barcode": r.cell_barcode, "degree": r.degree, "clone_id": r.assigned_clone_id} for k, r in sorted(held.items())], "links": []}
    for e in sorted(edges.collect(), key=lambda e: (e.node1, e.node2)):
        x, y = held[e.node1], held[e.node2]
        want["links"].append({
            "source": e.node1, "target": e.node2, "source_condition_1": x.source_condition, "source_condition_2": y.source_condition, "num_matches": e.num_matches, "num_exact_matches": e.num_exact_matches,
            "num_hamming_matches": e.num_hamming_matches, "best_hamming_distance": e.best_hamming_distance, "mean_match_confidence": e.mean_match_confidence, "confidence": e.mean_match_confidence,
            "edge_weight": e.edge_weight, "hamming": e.best_hamming_distance, "source_clone_id": x.assigned_clone_id, "target_clone_id": y.assigned_clone_id, "source_degree": x.degree, "target_degree": y.degree,
        })
    assert len(parts) > 1 and doc == want and [list(x) for x in doc["links"]] == [list(x) for x in want["links"]]
    tables.write_graph(nodes.limit(0), edges.limit(0), str(tmp_path / "none"))
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*")))) == {"directed": False, "graph": {}, "nodes": [], "links": []}


def test_stream(spark, tmp_path):
    """Batches add what they changed, folding keeps every count, and a batch that is written again changes none."""
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    counts = addresses.stream_molecules(addresses.stream_addresses(spark, str(folder)), 1)
    seen, changed = {}, []
    for n, line in enumerate(["1\tc\tu\tL\t0\n2\tc\tu\tL\t0\n3\tc\tu\tM\t4\n", "4\tc\tu\tL\t1\n5\td\tu\tL\t1\n", "6\te\tu\tL\t1\n", "7\td\tu\tL\t0\n", "8\td\tv\tL\t0\n"]):
        (folder / f"{n}.tsv").write_text(line)
        for fields in (x.split("\t") for x in line.splitlines()):
            if int(fields[4]) <= 1:
                seen[tuple(fields[1:4])] = seen.get(tuple(fields[1:4]), 0) + 1
        addresses.write_counts(counts, str(tmp_path / "state"), out, fold_every=3).awaitTermination()
        changed.append(spark.read.parquet(f"{out}/kind=changed/batch={n}").count())
        assert {(r[0], r[1], r[2]): r[3] for r in addresses.current_counts(spark, out).collect()} == seen
    assert changed == [1, 2, 1, 1, 1]  # not the whole table each time
    assert sorted(p.name for p in (tmp_path / "out").glob("kind=changed/*")) == ["batch=3", "batch=4"]
    again = spark.createDataFrame([("c", "u", "L", 2)], "cell_barcode string, umi string, lineage_barcode string, read_count long")
    again.write.parquet(f"{out}/kind=changed/batch=0")  # a batch of before the fold comes back
    addresses.fold_counts(spark, out, 5)
    assert len(list((tmp_path / "out").glob("kind=*/batch=*"))) == 1
    assert {(r[0], r[1], r[2]): r[3] for r in addresses.current_counts(spark, out).collect()} == seen
