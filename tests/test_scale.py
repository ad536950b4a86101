"""Steps whose work or tasks must grow no faster than the input."""

import random

from pyspark.sql import functions as F

from cladeworks.config import CloneParams
from cladeworks.functions import sequences, statistics
from cladeworks.operators import clones
from cladeworks.plans import fixtures, queries
from cladeworks.sources import tables
from cladeworks.streaming import addresses
from tests.test_blocks import shuffled

DATA = "/root/testdata/sf0.001"


def test_fisher_is_dealt_to_as_many_tasks_as_configured(spark):
    rows = spark.range(300).selectExpr("id + 1 AS a", "id % 17 + 1 AS b", "id % 5 + 1 AS c", "id % 11 + 1 AS d")
    parts = statistics.fisher_tables(rows).select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_steps_of_q_values_are_taken_from_the_end(spark):
    """No window runs from each row to the end of its range, which is quadratic in the rows."""
    rows = spark.range(2000).selectExpr("(id * 7919 % 2003 + 1) / 2004.0D AS p")
    found = statistics.benjamini_hochberg(rows, "p", "q")
    assert "currentrow$(), unboundedfollowing" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    ps, least, want = sorted(r.p for r in found.collect()), 1.0, {}
    for k in range(len(ps), 0, -1):
        least = min(least, ps[k - 1] * len(ps) / k)
        want[ps[k - 1]] = least
    assert all(abs(want[r.p] - r.q) < 1e-12 for r in found.collect())


def test_arriving_files_grow_in_number_and_batches_do_not(spark, monkeypatch):
    put, files, batches = tables.write_tsv, [], []
    monkeypatch.setattr(tables, "write_tsv", lambda df, path: (put(df, path), files.append(len(spark.read.text(path).inputFiles()))))
    fold = addresses.fold_counts
    monkeypatch.setattr(addresses, "fold_counts", lambda s, sink, n: (batches.append(n), fold(s, sink, n)))
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "10")
    try:
        assert queries.streamed_counts(spark, DATA).count() > 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    assert files == [10] and batches == [2]


def test_reads_are_dealt_before_their_sequences_are_made(spark):
    _, size = shuffled(spark, lambda: fixtures.fastq(spark, DATA))
    assert size < 400_000, size


def test_lines_that_are_not_looked_at_stay_out_of_python(spark, tmp_path):
    (tmp_path / "x.fastq").write_text("@a\nAC\n+\nII\n@b\nG\n+\nI\n")
    read = tables.read_fastq(spark, str(tmp_path / "x.fastq"))
    assert [tuple(r) for r in read.orderBy("ord").collect()] == [(0, "a", "AC"), (1, "b", "G")]
    assert "% 4) < 2" in read._jdf.queryExecution().executedPlan().toString()


def test_mismatches_match_brute_force(spark):
    rnd = random.Random(5)
    seqs = ["".join(rnd.choice("ACGTNa\n") for _ in range(n)) for n in range(60)]
    want = {s: sum(b not in ("AT", "GC", s)[i % 3] for i, b in enumerate(s)) for s in seqs}
    rows = spark.createDataFrame([(s,) for s in [*seqs, None]], "s string").select("s", sequences.wsn_mismatches(F.col("s")).alias("n"))
    assert {r.s: r.n for r in rows.collect()} == want | {None: None}
    assert "transform" not in rows._jdf.queryExecution().executedPlan().toString()


def test_links_are_written_in_compressed_files(spark):
    assert all(x.endswith(".gz") for x in queries.graph_file(spark, DATA).inputFiles())


def largest_task(spark, run):
    """The most bytes that a task of ``run`` holds in sorts, joins, aggregates and shuffles."""
    context = spark.sparkContext
    store, new = context._jsc.sc().statusStore(), lambda: context._jvm.java.util.ArrayList()

    def stages():
        found = store.stageList(new(), False, False, context._gateway.new_array(context._jvm.double, 0), new())
        return {(s.stageId(), s.attemptId()) for s in (found.apply(i) for i in range(found.size()))}

    before = stages()
    run()
    tasks = [store.taskList(*s, 1000) for s in stages() - before]
    metrics = [t.apply(i).taskMetrics() for t in tasks for i in range(t.size())]
    return max(m.get().peakExecutionMemory() for m in metrics if m.isDefined())


def test_listed_owners_are_dealt_to_tasks_of_like_memory(spark):
    """Cells that share each of their barcodes with about 25 others: many pairs from few bytes."""
    n = 12000
    seq = "concat_ws('', transform(sequence(0, 11), i -> substr('ACGT', cast(pmod(hash(i, b), 4) as int) + 1, 1)))"
    rows = spark.range(n).selectExpr("id", "explode(sequence(0, 7)) AS k").selectExpr("id", f"pmod(hash(id, k, 7), {8 * n // 25}) AS b").selectExpr("'s' AS source", "cast(id as string) AS cell", f"{seq} AS barcode").distinct().cache()
    owners = rows.groupBy("barcode").agg(F.count("*").alias("n"))
    assert rows.count() > 7 * n and owners.agg(F.max("n")).first()[0] <= clones.LISTED_OWNERS
    out = []
    size = largest_task(spark, lambda: out.extend(clones.clone_groups(rows, p=CloneParams(hamming_threshold=0)).collect()))
    both = rows.join(rows.select(F.col("cell").alias("other"), "barcode"), "barcode").where("cell <> other").select("cell", "other").distinct()
    want = {r.cell: r["count"] for r in both.groupBy("cell").count().collect()}
    assert len(out) == n and {r.cell_barcode: r.degree for r in out if r.degree} == want
    assert size < 160 << 20, size
