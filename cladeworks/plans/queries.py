"""Registered queries of the core engine and their SQL.

Each query runs an operator over whole driver tables, turned into barcode-shaped rows by ``fixtures``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.config import CloneParams, DirectParams, TimepointParams
from cladeworks.functions.sequences import hamming, match_confidence, wsn_mismatches
from cladeworks.operators import clones, cluster, direct, enrichment, molecules, noise, qc, timepoints
from cladeworks.operators.similarity import hamming_pairs
from cladeworks.plans import fixtures as fx
from cladeworks.runtime import materialize, numbered, read_table, sized
from cladeworks.sources import tables
from cladeworks.streaming import addresses

T0, CONTROL, TREATED = "A", "N", "R"
READS = f"reads AS ({fx.sql(fx.READS)})"


def _addresses(spark: SparkSession, d: str) -> DataFrame:
    return fx.reads(spark, d).withColumn("mismatches", wsn_mismatches(F.col("lineage_barcode")))


def wsn_mismatch(spark, d):
    return _addresses(spark, d).groupBy("lineage_barcode", "mismatches").agg(F.count("*").alias("reads"))


def filter_mismatch(spark, d):
    return molecules.filter_mismatches(_addresses(spark, d), 0).select("readid", "cell_barcode", "umi", "lineage_barcode", "mismatches")


def address_count(spark, d):
    return molecules.count_addresses(fx.reads(spark, d))


def _short(spark, d):
    return materialize(fx.short_molecules(spark, materialize(address_count(spark, d))))


def collapse_altered(spark, d):
    return molecules.altered_barcodes(_short(spark, d), "10xv3")


def collapse_barcodes(spark, d):
    return molecules.recount(molecules.collapse_barcodes(_short(spark, d), "10xv3"))


def translate_filter(spark, d):
    return molecules.translate_cells(address_count(spark, d), fx.whitelist(spark, d), fx.allowed(spark, d), 0)


def translate_filter_repeats(spark, d):
    """At a least count of 1, over UMIs of three bases, most of which have several reads."""
    counts = molecules.count_addresses(fx.reads(spark, d).withColumn("umi", F.substring("umi", 1, 3)))
    return molecules.translate_cells(counts, fx.whitelist(spark, d), fx.allowed(spark, d), 1)


def umi_counts(spark, d):
    return molecules.umi_counts(address_count(spark, d))


def _corrections(counts: DataFrame) -> DataFrame:
    """Corrections that send a mismatched first base back; a rule SQL can state too."""
    fixed = F.concat(F.lit("A"), F.substring("lineage_barcode", 2, 100))
    return counts.where(F.col("lineage_barcode").startswith("G")).select(F.col("cellbc").alias("cell_barcode"), fixed.alias("canonical_sequence"), F.col("lineage_barcode").alias("sequence_in_cluster"))


def correct_counts(spark, d):
    counts = umi_counts(spark, d)
    return molecules.correct_counts(counts, _corrections(counts))


def lost_cells(spark, d):
    counts = umi_counts(spark, d)
    kept = translate_filter(spark, d)
    return molecules.lost_cells(counts, kept)


def single_lineage(spark, d):
    return molecules.single_lineage_fraction(fx.corrected(spark, d))


def cluster_lineages(spark, d):
    return cluster.cluster_lineages(materialize(umi_counts(spark, d)), 1)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def noise_stats(spark, d):
    return _rounded(noise.noise_statistics(fx.corrected(spark, d, T0)))


def noise_filtered(spark, d):
    return _rounded(noise.filter_noise(fx.corrected(spark, d, T0)))


def lineage_hist(spark, d):
    return noise.lineage_histogram(noise.filter_noise(fx.corrected(spark, d, T0)))


def poisson_fit(spark, d):
    fit = noise.poisson_quality(noise.filter_noise(fx.corrected(spark, d, T0)))
    return _rounded(spark.createDataFrame([(fit.observed_mean, fit.rate, fit.ks_statistic, fit.p_value, fit.percent_infected)], "observed_mean double, rate double, ks_statistic double, p_value double, percent_infected double"))


def fuzzy_pairs(spark, d):
    a, b = (materialize(fx.reads(spark, d, c).select("lineage_barcode").distinct()) for c in (T0, TREATED))
    return hamming_pairs(a, b, 2)


def _prepared(spark, d, condition=T0, source="T0"):
    return materialize(clones.prepare_cells(fx.corrected(spark, d, condition).withColumn("lineage_count", F.col("total_lineages_per_cell")), source))


def clone_pairs_within(spark, d):
    return _rounded(clones.clone_pairs(_prepared(spark, d)))


def clone_pairs_full(spark, d):
    return _rounded(clones.clone_pairs(_prepared(spark, d), p=CloneParams(hamming_threshold=1, quick_mode=False)))


def clone_pairs_forced(spark, d):
    """The quick pass and the full scan both report."""
    return _rounded(clones.clone_pairs(_prepared(spark, d), p=CloneParams(hamming_threshold=1, force_hamming_all=True)))


def clone_pairs_cross(spark, d):
    return _rounded(clones.clone_pairs(_prepared(spark, d), _prepared(spark, d, TREATED, "T1")))


def _groups(spark, d, condition=T0, source="T0", degrees=True):
    prepared = _prepared(spark, d, condition, source)
    return prepared, materialize(clones.clone_groups(prepared, degrees=degrees))


def clone_groups(spark, d):
    return _groups(spark, d)[1]


def clone_groups_cross(spark, d):
    return clones.clone_groups(_prepared(spark, d), _prepared(spark, d, TREATED, "T1"), CloneParams(hamming_threshold=0))


def clone_groups_cross_near(spark, d):
    return clones.clone_groups(_prepared(spark, d), _prepared(spark, d, TREATED, "T1"), CloneParams(hamming_threshold=1))


def clone_barcodes(spark, d):
    prepared, groups = _groups(spark, d, degrees=False)
    return clones.clone_counts(groups, clones.clone_barcodes(prepared, groups))


def few_lineage_clones(spark, d):
    """Clones of cells below a number of lineages."""
    rows = fx.corrected(spark, d, T0).withColumn("lineage_count", F.col("total_lineages_per_cell"))
    return clones.clone_groups(materialize(clones.prepare_cells(rows, "T0", 20)), p=CloneParams(hamming_threshold=0))


def graph_nodes(spark, d):
    return clones.graph_nodes(_groups(spark, d)[1])


def hub_cells(spark, d):
    return clones.hub_cells(_groups(spark, d)[1], 1)


def graph_edges(spark, d):
    return clones.graph_edges(_rounded(clones.clone_pairs(_prepared(spark, d), texts=False)))


def graph_statistics(spark, d):
    return clones.graph_statistics(_groups(spark, d)[1])


def all_pairs_within(spark, d):
    """Every pair of cells is the result, so it grows with the square of the cells."""
    return _rounded(clones.all_pairs(_prepared(spark, d), p=CloneParams(hamming_threshold=0), texts=False))


def all_pairs_cross(spark, d):
    return _rounded(clones.all_pairs(_prepared(spark, d), _prepared(spark, d, TREATED, "T1"), CloneParams(hamming_threshold=0), texts=False))


def matched_cells(spark, d):
    return clones.matched_cells(_prepared(spark, d), _prepared(spark, d, TREATED, "T1"))


def legacy_clones(spark, d):
    return clones.exact_set_clones(fx.corrected(spark, d, T0))


def _clones_by_cell(spark, d, condition):
    """Clones for matching: each cell of a condition, numbered in the order of its barcode, with its lineages."""
    rows = materialize(fx.corrected(spark, d, condition))
    cells = numbered(rows.select("cell_barcode").distinct(), "clone_id", F.col("cell_barcode"))
    return materialize(rows.join(cells, "cell_barcode").select("clone_id", F.col("corrected_lineage_barcode").alias("barcode"), "umi_count"))


def _weights(rows):
    return rows.groupBy("barcode").agg(F.sum("umi_count").alias("weight"))


def _ranked_of(t0, t1, weighted=False):
    p = TimepointParams(hamming_threshold=1, weight_by_umi=weighted)
    sets = [x.select("clone_id", "barcode") for x in (t0, t1)]
    return materialize(timepoints.match_clones(*sets, p, *((_weights(t0), _weights(t1)) if weighted else (None, None)))), sets[0], sets[1]


def _ranked(spark, d, weighted=False, condition=TREATED):
    return _ranked_of(_clones_by_cell(spark, d, T0), _clones_by_cell(spark, d, condition), weighted)


def ranked_matches(spark, d):
    return _rounded(_ranked(spark, d)[0])


def ranked_matches_weighted(spark, d):
    return _rounded(_ranked(spark, d, True)[0])


def best_matches(spark, d):
    return _rounded(timepoints.best_matches(_ranked(spark, d)[0]))


def unmatched_clones(spark, d):
    ranked, _, t1 = _ranked(spark, d)
    return _rounded(timepoints.unmatched_clones(ranked, t1))


def match_statistics(spark, d):
    ranked, _, t1 = _ranked(spark, d)
    return _rounded(timepoints.match_statistics(ranked, t1))


def similarity_histogram(spark, d):
    return timepoints.similarity_histogram(timepoints.best_matches(_ranked(spark, d)[0]), 50)


def matched_sizes(spark, d):
    return _rounded(timepoints.matched_sizes(timepoints.best_matches(_ranked(spark, d)[0]), TimepointParams(similarity_threshold=0.5)))


def top_match_cells(spark, d):
    """The grid's cells in long form; the columns of a grid depend on the data."""
    ranked, _, _ = _ranked(spark, d)
    top = timepoints.best_matches(ranked).orderBy(F.desc("similarity_score"), "T1_clone_id").limit(30).select("T1_clone_id")
    return _rounded(ranked.join(F.broadcast(top), "T1_clone_id", "left_semi").select("T1_clone_id", "T0_clone_id", "similarity_score"))


def _both(spark, d):
    return [materialize(fx.corrected(spark, d, c)) for c in (T0, TREATED)]


def direct_matches(spark, d):
    return direct.match_cells(*_both(spark, d), DirectParams(hamming_threshold=1))


def direct_matches_weighted(spark, d):
    return direct.match_cells(*_both(spark, d), DirectParams(hamming_threshold=1, use_umi_weighting=True, jaccard_threshold=0.3, top_n=3))


def direct_exact(spark, d):
    """At distance 0 the greedy choice is the shared barcodes, which SQL can state."""
    out = direct.match_cells(*_both(spark, d), DirectParams(hamming_threshold=0))
    return out.select("T0_cell_barcode", "T1_cell_barcode", "T1_barcode_count", "matched_barcodes", "jaccard_similarity", "match_rank")


def merged_rows(spark, d):
    """Cells of counts whose rows are repeated: rows of one barcode are summed."""
    rows = materialize(fx.corrected(spark, d, T0))
    cells = direct.cells_of(rows.unionByName(rows.where("umi_count > 1")))
    return cells.select("cell", F.array_join("barcodes", ";").alias("barcodes"), "total")


def direct_summary(spark, d):
    return _rounded(direct.match_summary(direct_matches(spark, d)))


def _enriched(spark, d):
    t0 = _clones_by_cell(spark, d, T0)
    sizes = {}
    for c in (CONTROL, TREATED):
        rows = _clones_by_cell(spark, d, c)
        ranked, _, t1 = _ranked_of(t0, rows)
        sizes[c] = enrichment.sizes_by_t0(timepoints.best_matches(ranked), enrichment.clone_sizes(t1, _weights(rows)))
    return materialize(enrichment.run_enrichment(enrichment.clone_sizes(t0.select("clone_id", "barcode"), _weights(t0)), sizes[CONTROL], sizes[TREATED]))


def clone_sizes(spark, d):
    t0 = _clones_by_cell(spark, d, T0)
    return enrichment.clone_sizes(t0.select("clone_id", "barcode"), t0.groupBy("barcode").agg(F.sum("umi_count").alias("weight")))


def enrichment_results(spark, d):
    return _rounded(_enriched(spark, d))


def top_changed(spark, d):
    """The ten clones of each status with the strongest ratio."""
    results = _enriched(spark, d)
    return _rounded(enrichment.top_changed(results))


def plot_points(spark, d):
    return _rounded(enrichment.plot_points(_enriched(spark, d)))


def ratio_histogram(spark, d):
    return enrichment.ratio_histogram(_enriched(spark, d))


def barcode_sizes(spark, d):
    """Sizes of clones where no UMIs are known."""
    return enrichment.clone_sizes(_clones_by_cell(spark, d, T0).select("clone_id", "barcode"))


def enrichment_summary(spark, d):
    return _rounded(enrichment.enrichment_summary(_enriched(spark, d)))


def fisher_test(spark, d):
    """The exact test on its own, over counts of line items by supplier."""
    rows = read_table(spark, d, "lineitem").groupBy("l_suppkey").agg(*[F.count_if(F.col("l_returnflag") == c).alias(n) for c, n in ((T0, "a"), (CONTROL, "b"), (TREATED, "c"))])
    from cladeworks.functions.statistics import benjamini_hochberg, with_fisher_p

    rows = materialize(rows)
    rows = materialize(with_fisher_p(rows, F.col("a") + 1, F.col("b") + 1, F.col("a") + 1, F.col("c") + 1, "p_value"))
    return _rounded(benjamini_hochberg(rows, "p_value", "q_value"))


def cumulative_hist(spark, d):
    rows = fx.reads(spark, d).select("cell_barcode", F.col("lineage_barcode").alias("gene"))
    return _rounded(qc.cumulative_histogram(qc.molecules_per_cell(rows)))


def retention(spark, d):
    counts = _addresses(spark, d).agg(F.count("*").alias("original"), F.count_if(F.col("mismatches") <= 0).alias("processed"))
    return counts.select("original", "processed", F.round(qc.retention(F.col("original"), F.col("processed")), 6).alias("percent"))


def match_confidences(spark, d):
    pairs = fx.corrected(spark, d, T0).alias("x").join(fx.corrected(spark, d, TREATED).alias("y"), ["cell_barcode", "corrected_lineage_barcode"])
    c = match_confidence(F.col("x.umi_count"), F.col("y.umi_count"), F.col("x.total_lineages_per_cell"), F.col("y.total_lineages_per_cell"))
    return pairs.select("cell_barcode", "corrected_lineage_barcode", F.round(c, 6).alias("confidence"))


def hamming_distances(spark, d):
    """Distance of each cell barcode to its translated one, and of unequal lengths to a shorter one."""
    w = fx.whitelist(spark, d)
    return w.select("*", hamming(F.col("cell_barcode_gex"), F.col("cell_barcode_feature")).cast("int").alias("distance"), hamming(F.col("cell_barcode_gex"), F.substring("cell_barcode_feature", 1, 9)).cast("int").alias("unequal"))


def fastq_records(spark, d):
    """Records of a plain and of a gzipped file, by ordinal."""
    one, two = fx.fastq(spark, d)
    return one.select("ord", F.col("id").alias("id1"), F.col("seq").alias("seq1")).join(two.select("ord", F.col("id").alias("id2"), F.col("seq").alias("seq2")), "ord")


def fastq_extract(spark, d):
    return molecules.extract_addresses(*fx.fastq(spark, d), fx.PREFIX)


def extraction_counts(spark, d):
    return molecules.extraction_counters(*fx.fastq(spark, d), fx.PREFIX)


def addresses_file(spark, d):
    """Addresses written and read back, among lines that are no addresses."""
    path = fx.folder(spark, "addresses")
    rows = _addresses(spark, d).select("readid", "cell_barcode", "umi", "lineage_barcode", "mismatches")
    broken = rows.select(F.concat_ws(" ", "readid", "umi").alias("value"))
    rows.select(F.concat_ws("\t", *rows.columns).alias("value")).unionByName(broken).write.text(path)
    return tables.read_addresses(spark, path)


def molecules_file(spark, d):
    path = fx.folder(spark, "molecules")
    tables.write_words(address_count(spark, d), path)
    return tables.read_molecules(spark, path)


def corrections_file(spark, d):
    """Corrections with a header line, read back with and without it."""
    path = fx.folder(spark, "corrections")
    tables.write_tsv(_corrections(umi_counts(spark, d)), path, header=True)
    return tables.read_corrections(spark, path)


def whitelist_file(spark, d):
    path = fx.folder(spark, "whitelist")
    tables.write_tsv(fx.whitelist(spark, d).select("cell_barcode_gex", "cell_barcode_feature"), path, compression="gzip")
    return tables.read_whitelist(spark, path).drop("line")


def allow_list_file(spark, d):
    """Allowed cells from a file of one column and from one of three."""
    one, three = fx.folder(spark, "allow1"), fx.folder(spark, "allow3")
    rows = fx.allowed(spark, d)
    tables.write_tsv(rows, one, single=True)
    tables.write_tsv(rows.select("cell_barcode_gex", F.lit(1), F.lit("x")), three, single=True)
    return tables.read_allow_list(spark, one).select("cell_barcode_gex").unionByName(tables.read_allow_list(spark, three).select("cell_barcode_gex"))


def counts_file(spark, d):
    path = fx.folder(spark, "counts")
    tables.write_tsv(fx.corrected(spark, d), path, header=True)
    return tables.read_counts(spark, path)


def clones_file(spark, d):
    """Clone barcodes written, read back and taken apart."""
    path = fx.folder(spark, "clones")
    tables.write_tsv(clone_barcodes(spark, d).select("cloneID", "clone_barcode"), path, header=True)
    return timepoints.explode_clones(tables.read_clone_barcodes(spark, path))


def clone_map_file(spark, d):
    path = fx.folder(spark, "map")
    tables.write_tsv(best_matches(spark, d), path, header=True)
    return tables.read_clone_map(spark, path)


def matches_file(spark, d):
    """Direct matches as the CSV file has them."""
    path = fx.folder(spark, "matches")
    tables.write_matches(direct_exact(spark, d), path)
    return spark.read.option("header", True).csv(path)


def graph_file(spark, d):
    """Links of the graph as JSON lines, read back."""
    path, edges = fx.folder(spark, "graph"), graph_edges(spark, d)
    tables.graph_records(edges).write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)  # a line a link
    return spark.read.schema(edges.schema).json(path)


def cell_counts(spark, d):
    """Cells before and after translation."""
    return qc.cells_before_and_after(address_count(spark, d), _untranslated(spark, d))


def _untranslated(spark, d):
    """Molecules of cells that translation keeps, under their own names."""
    w = fx.whitelist(spark, d).join(sized(fx.allowed(spark, d)), "cell_barcode_gex", "left_semi")
    return address_count(spark, d).join(sized(w.select(F.col("cell_barcode_feature").alias("cell_barcode"))), "cell_barcode", "left_semi")


def clone_size_histogram(spark, d):
    groups = _groups(spark, d, degrees=False)[1]
    return groups.select("cloneID", "clone_size").distinct().groupBy("clone_size").agg(F.count("*").alias("clones"))


def streamed_counts(spark, d):
    """Reads of molecules, over UMIs of three bases, kept up to date while addresses arrive in several files."""
    path, state, sink = (fx.folder(spark, n) for n in ("arriving", "state", "streamed"))
    rows = _addresses(spark, d).select("readid", "cell_barcode", F.substring("umi", 1, 3).alias("umi"), "lineage_barcode", "mismatches")
    files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))  # a file is written by one task, so there are more of them than batches
    tables.write_tsv(rows.repartition(files, "readid"), path)
    addresses.write_counts(addresses.stream_molecules(addresses.stream_addresses(spark, path, -(-files // 4)), 0), state, sink, fold_every=2).awaitTermination()
    return addresses.current_counts(spark, sink)


QUERIES = {
    f.__name__: f
    for f in (
        umi_counts, wsn_mismatch, filter_mismatch, address_count, collapse_altered, collapse_barcodes, translate_filter, translate_filter_repeats, correct_counts, lost_cells, single_lineage, cluster_lineages,
        noise_stats, noise_filtered, lineage_hist, poisson_fit, fuzzy_pairs, clone_pairs_within, clone_pairs_full, clone_pairs_forced, clone_pairs_cross, clone_groups, clone_barcodes, graph_nodes, graph_edges,
        graph_statistics, matched_cells, legacy_clones, ranked_matches, ranked_matches_weighted, best_matches, unmatched_clones, match_statistics, top_match_cells, direct_matches,
        direct_matches_weighted, direct_exact, merged_rows, direct_summary, clone_sizes, enrichment_results, enrichment_summary, fisher_test, cumulative_hist, retention, match_confidences, hamming_distances,
        clone_groups_cross, clone_groups_cross_near, few_lineage_clones, hub_cells, all_pairs_within, all_pairs_cross, top_changed, plot_points, ratio_histogram, barcode_sizes, fastq_records, fastq_extract, extraction_counts, addresses_file, molecules_file,
        corrections_file, whitelist_file, allow_list_file, counts_file, clones_file, clone_map_file, matches_file, graph_file, cell_counts, clone_size_histogram, streamed_counts, similarity_histogram, matched_sizes,
    )
}


def _mol() -> str:
    return f"WITH {READS}, molecules AS (SELECT cell_barcode, umi, lineage_barcode, count(*) AS read_count FROM reads GROUP BY ALL)"


_WSN = "list_sum(list_transform(range(1, 25), lambda i: CASE WHEN (i - 1) % 3 = 0 AND substr(lineage_barcode, i, 1) NOT IN ('A', 'T') THEN 1 WHEN (i - 1) % 3 = 1 AND substr(lineage_barcode, i, 1) NOT IN ('G', 'C') THEN 1 ELSE 0 END))::INT"
_LONG_WSN = _WSN.replace("range(1, 25)", "range(1, 85)").replace("lineage_barcode", "b")
_UMI = """u AS (SELECT *, sum(unique_umi_count) OVER (PARTITION BY cellbc)::BIGINT AS total_unique_umis, count(*) OVER (PARTITION BY cellbc) AS total_unique_lineage_barcodes
FROM (SELECT cell_barcode AS cellbc, lineage_barcode, count(DISTINCT umi) AS unique_umi_count FROM molecules GROUP BY ALL))"""
_SHORT = f"s AS ({fx.SHORT}), ok AS (SELECT * FROM s WHERE cell_barcode NOT LIKE '%N%' AND cell_barcode NOT LIKE '%GGGGG%')"
_ALTERED = """c AS (SELECT cell_barcode, count(*) AS n, count(*) FILTER (substr(umi, 12, 1) = 'T') / count(*) > 0.9 AS high FROM ok GROUP BY 1),
a AS (SELECT cell_barcode AS bc_old, substr(cell_barcode, 1, 15) AS bc_new FROM c WHERE high AND length(cell_barcode) = 16 AND substr(cell_barcode, 1, 15) IN (SELECT substr(cell_barcode, 1, 15) FROM c WHERE high AND n >= 20))"""
_TRANSLATED = f"""w AS ({fx.sql(fx.WHITELIST)}), al AS ({fx.sql(fx.ALLOWED)}),
t AS (SELECT w.cell_barcode_gex AS cell_barcode, umi, lineage_barcode, read_count FROM molecules m JOIN w ON m.cell_barcode = w.cell_barcode_feature WHERE read_count > 0 AND w.cell_barcode_gex IN (SELECT cell_barcode_gex FROM al))"""


def _noise() -> str:
    return f"""WITH {READS}, k AS ({fx.corrected_sql(T0)}),
n AS (SELECT *, umi_count / sum(umi_count) OVER (PARTITION BY cell_barcode) * 10000.0 AS normalized_umi_count FROM k),
l AS (SELECT *, ln(1 + normalized_umi_count) AS log_normalized_umi_count FROM n),
r AS (SELECT *, row_number() OVER (PARTITION BY cell_barcode ORDER BY log_normalized_umi_count DESC, corrected_lineage_barcode)::DOUBLE AS rank, count(*) OVER (PARTITION BY cell_barcode) AS lineage_count FROM l),
e AS (SELECT *, avg(log_normalized_umi_count) FILTER (rank <= 1) OVER (PARTITION BY cell_barcode) AS expected_count, stddev_samp(log_normalized_umi_count) OVER (PARTITION BY lineage_count) AS std_dev,
  max(log_normalized_umi_count) OVER (PARTITION BY lineage_count) = min(log_normalized_umi_count) OVER (PARTITION BY lineage_count) AS level, lineage_count < 5 AS is_small_group FROM r),
z AS (SELECT *, CASE WHEN is_small_group OR std_dev IS NULL THEN NULL WHEN std_dev = 0 OR level THEN 0.0 ELSE (log_normalized_umi_count - expected_count) / std_dev END AS z_score FROM e),
f AS (SELECT * REPLACE (count(*) OVER (PARTITION BY cell_barcode) AS lineage_count) FROM z WHERE abs(z_score) < 2)"""


_NOISE_COLUMNS = "cell_barcode, corrected_lineage_barcode, umi_count, total_molecules_per_cell, total_lineages_per_cell, round(normalized_umi_count, 6) AS normalized_umi_count, round(log_normalized_umi_count, 6) AS log_normalized_umi_count, rank, round(expected_count, 6) AS expected_count, lineage_count, round(std_dev, 6) AS std_dev, is_small_group, round(z_score, 6) AS z_score"


def _prep(name: str, source: str, condition: str) -> str:
    return f"""{name} AS (SELECT '{source}' AS source, cell_barcode AS cell, corrected_lineage_barcode AS barcode, umi_count AS umi, row_number() OVER (PARTITION BY cell_barcode ORDER BY umi_count DESC, corrected_lineage_barcode) AS rank,
  count(*) OVER (PARTITION BY cell_barcode) AS n FROM ({fx.corrected_sql(condition)}))"""


def _pairs(cross: bool, d: int = 2, quick: bool = True) -> str:
    two, test = ("p1", "TRUE") if cross else ("p0", "x.cell < y.cell")
    exact = "bool_or(distance = 0)" if quick else "FALSE"
    return f"""WITH RECURSIVE {READS}, {_prep("p0", "T0", T0)}, {_prep("p1", "T1", TREATED)},
near AS (SELECT x.source AS s1, x.cell AS c1, y.source AS s2, y.cell AS c2, hamming(x.barcode, y.barcode) AS distance, x.n * y.n AS every, x.barcode AS b1, y.barcode AS b2, x.umi AS u1, y.umi AS u2, x.rank AS r1, y.rank AS r2,
  0.7 * (least(x.umi, y.umi) / greatest(x.umi, y.umi)) + 0.3 / (1 + abs(x.rank - y.rank)) AS confidence
  FROM p0 x JOIN {two} y ON {test} AND hamming(x.barcode, y.barcode) <= {d}),
told AS (SELECT *, concat(b1, '|', b2, '|d:', distance, '|c:', printf('%.4f', confidence), '|u1:', u1, '|u2:', u2, '|r1:', r1, '|r2:', r2) AS m FROM near),
pairs AS (SELECT c1 AS cell_barcode_1, c2 AS cell_barcode_2, s1 AS source_condition_1, s2 AS source_condition_2, TRUE AS is_clone,
  CASE WHEN {exact} THEN count(*) FILTER (distance = 0) ELSE count(*) END AS num_matches, count(*) FILTER (distance = 0) AS num_exact_matches,
  CASE WHEN {exact} THEN 0 ELSE count(*) FILTER (distance > 0) END AS num_hamming_matches, CASE WHEN {exact} THEN count(*) FILTER (distance = 0) ELSE any_value(every) END AS num_barcode_comparisons,
  min(distance)::BIGINT AS min_observed_distance, min(distance)::BIGINT AS best_hamming_distance, CASE WHEN {exact} THEN avg(confidence) FILTER (distance = 0) ELSE avg(confidence) END AS mean_match_confidence,
  CASE WHEN {exact} THEN string_agg(m, ';' ORDER BY b1, b2) FILTER (distance = 0) ELSE string_agg(m, ';' ORDER BY b1, b2) END AS matched_barcode_pairs
  FROM told GROUP BY ALL)"""


_GROUPS = """, e AS (SELECT cell_barcode_1 AS a, cell_barcode_2 AS b FROM pairs UNION SELECT cell_barcode_2, cell_barcode_1 FROM pairs),
nodes AS (SELECT DISTINCT cell FROM p0),
reach AS (SELECT cell, cell AS root FROM nodes UNION SELECT e.b, reach.root FROM reach JOIN e ON e.a = reach.cell),
parts AS (SELECT cell, min(root) AS root FROM reach GROUP BY 1),
sizes AS (SELECT root, count(*) AS clone_size, row_number() OVER (ORDER BY count(*) DESC, root) AS "cloneID" FROM parts GROUP BY 1),
groups AS (SELECT "cloneID", 'T0' AS source_condition, cell AS cell_barcode, clone_size, (SELECT count(*) FROM e WHERE a = cell) AS degree FROM parts JOIN sizes USING (root))"""


def _every(cross: bool) -> str:
    """All pairs of cells, matched at distance 0 or not."""
    two, test = ("c1", "TRUE") if cross else ("c0", "x.cell < y.cell")
    side = lambda c, p: f"{c} AS (SELECT source, cell, list(barcode) AS bs FROM {p} GROUP BY ALL)"
    zero = lambda c: f"coalesce({c}, 0)::BIGINT AS {c}"
    return f"""{_pairs(cross, 0)}, {side("c0", "p0")}, {side("c1", "p1")},
every AS (SELECT x.cell AS cell_barcode_1, y.cell AS cell_barcode_2, x.source AS source_condition_1, y.source AS source_condition_2, list_min(flatten([[hamming(a, b) for b in y.bs] for a in x.bs]))::BIGINT AS observed, len(x.bs) * len(y.bs) AS n FROM c0 x JOIN {two} y ON {test})
SELECT cell_barcode_1, cell_barcode_2, source_condition_1, source_condition_2, coalesce(is_clone, FALSE) AS is_clone, {zero("num_matches")}, {zero("num_exact_matches")}, {zero("num_hamming_matches")},
  coalesce(num_barcode_comparisons, n) AS num_barcode_comparisons, observed AS min_observed_distance, best_hamming_distance, round(mean_match_confidence, 6) AS mean_match_confidence
FROM every LEFT JOIN pairs USING (cell_barcode_1, cell_barcode_2, source_condition_1, source_condition_2)"""


def _components(ends: str, rows: str) -> str:
    """Components, numbered, with degrees, of ``rows(source, cell)`` tied by ``ends(s1, c1, s2, c2)``."""
    return f"""ends AS ({ends}), e AS (SELECT s1 || '|' || c1 AS a, s2 || '|' || c2 AS b FROM ends UNION SELECT s2 || '|' || c2, s1 || '|' || c1 FROM ends),
nodes AS (SELECT DISTINCT source, cell, source || '|' || cell AS node FROM ({rows})),
reach AS (SELECT node, node AS root FROM nodes UNION SELECT e.b, reach.root FROM reach JOIN e ON e.a = reach.node),
parts AS (SELECT node, min(root) AS root FROM reach GROUP BY 1),
sizes AS (SELECT root, count(*) AS clone_size, row_number() OVER (ORDER BY count(*) DESC, min(struct_pack(source, cell))) AS "cloneID" FROM parts JOIN nodes USING (node) GROUP BY 1)
SELECT "cloneID", source AS source_condition, cell AS cell_barcode, clone_size, (SELECT count(*) FROM e WHERE a = node) AS degree FROM parts JOIN sizes USING (root) JOIN nodes USING (node)"""


def _direct(d: int, least: float, weighted: bool, top: int = 0) -> str:
    """Greedy one-to-one matches, an edge of each pair of cells a round."""
    score = "weighted" if weighted else "jaccard"
    cut = f"WHERE match_rank <= {top}" if top else ""
    extra, none = (", round(weighted, 6) AS umi_weighted_similarity", ", 0.0::DOUBLE") if weighted else ("", "")
    side = lambda n, c: f"k{n} AS ({fx.corrected_sql(c)}), s{n} AS (SELECT cell_barcode AS c, string_agg(corrected_lineage_barcode, ';' ORDER BY corrected_lineage_barcode) AS t, count(*)::INT AS n, sum(umi_count)::BIGINT AS u FROM k{n} GROUP BY 1)"
    return f"""WITH RECURSIVE {READS}, {side(0, T0)}, {side(1, TREATED)},
g AS (SELECT k1.cell_barcode AS c1, k0.cell_barcode AS c0, list({{'d': hamming(k1.corrected_lineage_barcode, k0.corrected_lineage_barcode), 'a': k1.corrected_lineage_barcode, 'b': k0.corrected_lineage_barcode, 'w': least(k1.umi_count, k0.umi_count)}}
  ORDER BY hamming(k1.corrected_lineage_barcode, k0.corrected_lineage_barcode), k1.corrected_lineage_barcode, k0.corrected_lineage_barcode) AS e
  FROM k1 JOIN k0 ON hamming(k1.corrected_lineage_barcode, k0.corrected_lineage_barcode) <= {d} GROUP BY ALL),
r AS (SELECT c1, c0, e, 1 AS i, []::VARCHAR[] AS a, []::VARCHAR[] AS b, 0 AS k, 0 AS far, 0::BIGINT AS w FROM g UNION ALL
  SELECT c1, c0, e, i + 1, CASE WHEN free THEN list_append(a, e[i].a) ELSE a END, CASE WHEN free THEN list_append(b, e[i].b) ELSE b END, k + free::INT, far + CASE WHEN free THEN e[i].d ELSE 0 END::INT, w + CASE WHEN free THEN e[i].w ELSE 0 END
  FROM (SELECT *, NOT list_contains(a, e[i].a) AND NOT list_contains(b, e[i].b) AS free FROM r WHERE i <= len(e))),
t AS (SELECT c1, c0, k, far / k AS mean, w, s1.n AS n1, s0.n AS n0, s1.t AS t1, s0.t AS t0, k / (s1.n + s0.n - k) AS jaccard, w / (s1.u + s0.u - w) AS weighted FROM r JOIN s1 ON s1.c = c1 JOIN s0 ON s0.c = c0 WHERE i = len(e) + 1 AND k >= 2),
o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c1 ORDER BY {score} DESC, k DESC, mean, c0)::INT AS match_rank FROM t WHERE {score} >= {least}) {cut}),
direct AS (SELECT c0 AS "T0_cell_barcode", t0 AS "T0_barcodes", n0 AS "T0_barcode_count", c1 AS "T1_cell_barcode", t1 AS "T1_barcodes", n1 AS "T1_barcode_count", k AS matched_barcodes, round(jaccard, 6) AS jaccard_similarity{extra}, match_rank FROM o
UNION ALL SELECT 'NO_MATCH', 'NO_MATCH', 0, c, t, n, 0, 0.0{none}, 1 FROM s1 WHERE c NOT IN (SELECT c1 FROM o))"""


_POISSON = """, ph AS (SELECT lineage_count AS v, count(DISTINCT cell_barcode) AS n FROM f GROUP BY 1), pm AS (SELECT sum(v * n) / sum(n) AS mean, sum(n) AS total, count(*) AS c FROM ph),
pb AS (SELECT 0 AS i, 0.0::DOUBLE AS lo, mean::DOUBLE AS hi FROM pm UNION ALL SELECT i + 1, CASE WHEN x < mean THEN mid ELSE lo END, CASE WHEN x < mean THEN hi ELSE mid END
  FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid, (lo + hi) / 2 / (1 - exp(-(lo + hi) / 2)) AS x, mean FROM pb, pm WHERE i < 100)),
pr AS (SELECT CASE WHEN mean <= 1 THEN 0.0 ELSE (lo + hi) / 2 END AS rate FROM pb, pm WHERE i = 100),
py AS (SELECT 1 AS s, sum(n) OVER (ORDER BY v) / total AS y FROM ph, pm UNION ALL
  SELECT -1, sum(CASE WHEN rate = 0 THEN CASE WHEN g.i = 1 THEN 1.0 ELSE 0.0 END ELSE exp(g.i * ln(greatest(rate, 1e-300)) - rate - lgamma(g.i + 1)) / (1 - exp(-rate)) END) OVER (ORDER BY g.i) FROM pr, (SELECT unnest(range(1, (SELECT c + 1 FROM pm)::BIGINT)) AS i) g),
pk AS (SELECT max(abs(gap)) AS gap FROM (SELECT sum(s) OVER (ORDER BY y RANGE UNBOUNDED PRECEDING) AS gap FROM py)),
pp AS (SELECT CASE WHEN gap = 0 THEN 1.0 ELSE least(1.0, greatest(0.0, (SELECT 2 * sum(CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END * exp(2 * lgamma(c + 1) - lgamma(c - j * gap + 1) - lgamma(c + j * gap + 1))) FROM (SELECT unnest(range(1, (c // greatest(gap, 1) + 1)::BIGINT)) AS j)))) END AS p FROM pk, pm)
SELECT round(mean, 6) AS observed_mean, round(rate, 6) AS rate, round(gap / c, 6) AS ks_statistic, round(p, 6) AS p_value, round((1 - exp(-rate)) * 100, 6) AS percent_infected FROM pm, pr, pk, pp"""


def _cells(name: str, condition: str) -> str:
    return f"{name} AS (SELECT dense_rank() OVER (ORDER BY cell_barcode) AS clone_id, corrected_lineage_barcode AS barcode, umi_count FROM ({fx.corrected_sql(condition)}))"


def _match(t1: str, out: str) -> str:
    """Ranked matches of the clones ``t1`` against ``x0``, with UMI weights."""
    return f"""{out}_m AS (SELECT a.clone_id AS t1, a.barcode AS b1, b.clone_id AS t0, b.barcode AS b0 FROM {t1} a JOIN x0 b ON hamming(a.barcode, b.barcode) <= 1),
{out}_w1 AS (SELECT barcode, sum(umi_count) AS w FROM {t1} GROUP BY 1), {out}_w0 AS (SELECT barcode, sum(umi_count) AS w FROM x0 GROUP BY 1),
{out}_n1 AS (SELECT clone_id, count(*) AS n, sum(w) AS w FROM {t1} JOIN {out}_w1 USING (barcode) GROUP BY 1), {out}_n0 AS (SELECT clone_id, count(*) AS n, sum(w) AS w FROM x0 JOIN {out}_w0 USING (barcode) GROUP BY 1),
{out}_c1 AS (SELECT t1, t0, count(*) AS k, sum(w) AS w FROM (SELECT DISTINCT t1, t0, b1 FROM {out}_m) JOIN {out}_w1 ON barcode = b1 GROUP BY ALL), {out}_c0 AS (SELECT t1, t0, sum(w) AS w FROM (SELECT DISTINCT t1, t0, b0 FROM {out}_m) JOIN {out}_w0 ON barcode = b0 GROUP BY ALL),
{out}_s AS (SELECT c.t1 AS "T1_clone_id", c.t0 AS "T0_clone_id", c.k / (n1.n + n0.n - c.k) AS similarity_score, (c.w + o.w) / (n1.w + n0.w) AS umi_weighted_score, c.k AS num_matched_barcodes, n1.n AS "num_T1_barcodes", n0.n AS "num_T0_barcodes"
  FROM {out}_c1 c JOIN {out}_c0 o USING (t1, t0) JOIN {out}_n1 n1 ON n1.clone_id = c.t1 JOIN {out}_n0 n0 ON n0.clone_id = c.t0),
{out} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "T1_clone_id" ORDER BY similarity_score DESC, "T0_clone_id") AS match_rank FROM {out}_s) WHERE match_rank <= 5)"""


_RANKED = f"WITH {READS}, {_cells('x0', T0)}, {_cells('x1', TREATED)}, {_match('x1', 'ranked')}"
_SIM = "round(similarity_score, 6) AS similarity_score"
_COUNTS = 'num_matched_barcodes, "num_T1_barcodes", "num_T0_barcodes"'


def _fisher(a: str, b: str, c: str, d: str) -> str:
    """Two-sided p over the support of the table [[a, b], [c, d]]."""
    f = lambda e: f"lgamma(({e}) + 1)"
    chance = lambda x: f"({f(f'{a} + {b}')} + {f(f'{c} + {d}')} + {f(f'{a} + {c}')} + {f(f'{b} + {d}')} - {f(f'{a} + {b} + {c} + {d}')} - {f(x)} - {f(f'{a} + {b} - ({x})')} - {f(f'{a} + {c} - ({x})')} - {f(f'{d} - {a} + ({x})')})"
    return f"(SELECT least(1.0, sum(exp(v)) FILTER (v <= {chance(a)} + ln(1.0000001))) FROM (SELECT {chance('g.x')} AS v FROM (SELECT unnest(range(greatest(0, {a} - {d})::BIGINT, least({a} + {b}, {a} + {c})::BIGINT + 1)) AS x) g))"


_BH = "least(1.0, min(p_value * m / r) OVER (ORDER BY r DESC ROWS UNBOUNDED PRECEDING))"
_ENRICHED = f"""WITH {READS}, {_cells("x0", T0)}, {_cells("x1", TREATED)}, {_cells("x2", CONTROL)}, {_match("x1", "rt")}, {_match("x2", "rc")},
z0 AS (SELECT clone_id, w AS size FROM rt_n0), zt AS (SELECT "T0_clone_id" AS clone_id, sum(n.w) AS size FROM rt JOIN rt_n1 n ON n.clone_id = "T1_clone_id" WHERE match_rank = 1 GROUP BY 1),
zc AS (SELECT "T0_clone_id" AS clone_id, sum(n.w) AS size FROM rc JOIN rc_n1 n ON n.clone_id = "T1_clone_id" WHERE match_rank = 1 GROUP BY 1),
y AS (SELECT z0.clone_id AS "Clone_ID", z0.size::BIGINT AS "T0_size", coalesce(zc.size, 0)::BIGINT AS "Control_size", coalesce(zt.size, 0)::BIGINT AS "Treated_size" FROM z0 LEFT JOIN zc USING (clone_id) LEFT JOIN zt USING (clone_id)),
p AS (SELECT *, ("Control_size" + 1.0) / ("T0_size" + 1.0) AS "FC_control", ("Treated_size" + 1.0) / ("T0_size" + 1.0) AS "FC_treated", {_fisher('("T0_size" + 1)', '("Control_size" + 1)', '("T0_size" + 1)', '("Treated_size" + 1)')} AS p_value FROM y),
q AS (SELECT *, log2("FC_treated" / "FC_control") AS "Log2_FC_ratio", row_number() OVER (ORDER BY p_value) AS r, count(*) OVER () AS m FROM p),
h AS (SELECT *, {_BH} AS q_value FROM q),
res AS (SELECT *, CASE WHEN q_value < 0.05 AND "Log2_FC_ratio" > 1 THEN 'Enriched' WHEN q_value < 0.05 AND "Log2_FC_ratio" < -1 THEN 'Depleted' ELSE 'Neutral' END AS "Status" FROM h)"""

#: Direct matches at distance 0 as rows.
_EXACT = f"""WITH {READS}, k0 AS ({fx.corrected_sql(T0)}), k1 AS ({fx.corrected_sql(TREATED)}),
m AS (SELECT k1.cell_barcode AS c1, k0.cell_barcode AS c0, count(*)::INT AS k, any_value(k1.total_lineages_per_cell)::INT AS n1, any_value(k0.total_lineages_per_cell)::INT AS n0 FROM k1 JOIN k0 USING (corrected_lineage_barcode) GROUP BY ALL HAVING count(*) >= 2),
r AS (SELECT *, k / (n1 + n0 - k) AS j, row_number() OVER (PARTITION BY c1 ORDER BY k / (n1 + n0 - k) DESC, k DESC, c0)::INT AS match_rank FROM m WHERE k / (n1 + n0 - k) >= 0.6),
x AS (SELECT c0 AS "T0_cell_barcode", c1 AS "T1_cell_barcode", n1 AS "T1_barcode_count", k AS matched_barcodes, round(j, 6) AS jaccard_similarity, match_rank FROM r
UNION ALL SELECT DISTINCT 'NO_MATCH', cell_barcode, total_lineages_per_cell::INT, 0, 0.0, 1 FROM k1 WHERE cell_barcode NOT IN (SELECT c1 FROM r))"""

SQL = {
    "umi_counts": f"{_mol()}, {_UMI} SELECT * FROM u",
    "wsn_mismatch": f"WITH {READS} SELECT lineage_barcode, {_WSN} AS mismatches, count(*) AS reads FROM reads GROUP BY ALL",
    "filter_mismatch": f"WITH {READS} SELECT readid, cell_barcode, umi, lineage_barcode, {_WSN} AS mismatches FROM reads WHERE {_WSN} <= 0",
    "address_count": f"{_mol()} SELECT * FROM molecules",
    "collapse_altered": f"{_mol()}, {_SHORT}, {_ALTERED} SELECT * FROM a",
    "collapse_barcodes": f"""{_mol()}, {_SHORT}, {_ALTERED}
SELECT CASE WHEN bc_old IS NULL THEN cell_barcode ELSE bc_new END AS cell_barcode, CASE WHEN bc_old IS NULL THEN umi ELSE concat(substr(cell_barcode, 16, 1), substr(umi, 1, 11)) END AS umi, lineage_barcode, sum(read_count)::BIGINT AS read_count
FROM ok LEFT JOIN a ON bc_old = cell_barcode GROUP BY ALL""",
    "translate_filter_repeats": f"""WITH {READS}, molecules AS (SELECT cell_barcode, substr(umi, 1, 3) AS umi, lineage_barcode, count(*) AS read_count FROM reads GROUP BY ALL), {_TRANSLATED.replace("read_count > 0", "read_count > 1")} SELECT * FROM t""",
    "clone_groups_cross_near": f"{_pairs(True, 1)}, {_components('SELECT s1, c1, s2, c2 FROM near', 'SELECT source, cell FROM p0 UNION ALL SELECT source, cell FROM p1')}",
    "clone_pairs_forced": f"""{_pairs(False, 1)} SELECT c1 AS cell_barcode_1, c2 AS cell_barcode_2, s1 AS source_condition_1, s2 AS source_condition_2, TRUE AS is_clone,
  count(*) + count(*) FILTER (distance = 0) AS num_matches, 2 * count(*) FILTER (distance = 0) AS num_exact_matches, count(*) FILTER (distance > 0) AS num_hamming_matches, any_value(every) + count(*) FILTER (distance = 0) AS num_barcode_comparisons,
  min(distance)::BIGINT AS min_observed_distance, min(distance)::BIGINT AS best_hamming_distance, round((sum(confidence) + coalesce(sum(confidence) FILTER (distance = 0), 0)) / (count(*) + count(*) FILTER (distance = 0)), 6) AS mean_match_confidence,
  concat_ws(';', string_agg(m, ';' ORDER BY b1, b2) FILTER (distance = 0), string_agg(m, ';' ORDER BY b1, b2)) AS matched_barcode_pairs FROM told GROUP BY ALL""",
    "merged_rows": f"""WITH {READS}, k AS ({fx.corrected_sql(T0)}), r AS (SELECT cell_barcode, corrected_lineage_barcode, umi_count FROM k UNION ALL SELECT cell_barcode, corrected_lineage_barcode, umi_count FROM k WHERE umi_count > 1)
SELECT cell_barcode AS cell, string_agg(DISTINCT corrected_lineage_barcode, ';' ORDER BY corrected_lineage_barcode) AS barcodes, sum(umi_count)::BIGINT AS total FROM r GROUP BY 1""",
    "translate_filter": f"{_mol()}, {_TRANSLATED} SELECT * FROM t",
    "correct_counts": f"""{_mol()}, {_UMI}, k AS (SELECT cellbc AS cell_barcode, CASE WHEN lineage_barcode LIKE 'G%' THEN concat('A', substr(lineage_barcode, 2)) ELSE lineage_barcode END AS corrected_lineage_barcode, sum(unique_umi_count)::BIGINT AS umi_count FROM u GROUP BY ALL)
SELECT *, sum(umi_count) OVER (PARTITION BY cell_barcode)::BIGINT AS total_molecules_per_cell, count(*) OVER (PARTITION BY cell_barcode) AS total_lineages_per_cell FROM k""",
    "cluster_lineages": f"""WITH RECURSIVE {_mol().removeprefix("WITH ")}, {_UMI}, l AS (SELECT x.cellbc AS cell, x.lineage_barcode AS child, y.lineage_barcode AS parent FROM u x JOIN u y ON x.cellbc = y.cellbc AND y.unique_umi_count >= 5 * x.unique_umi_count AND levenshtein(x.lineage_barcode, y.lineage_barcode) <= 1
  AND x.lineage_barcode <> y.lineage_barcode QUALIFY row_number() OVER (PARTITION BY x.cellbc, x.lineage_barcode ORDER BY y.unique_umi_count DESC, y.lineage_barcode) = 1),
up AS (SELECT cellbc AS cell, lineage_barcode AS seq, lineage_barcode AS root FROM u UNION ALL SELECT up.cell, up.seq, l.parent FROM up JOIN l ON l.cell = up.cell AND l.child = up.root)
SELECT up.cell AS cell_barcode, root AS canonical_sequence, seq AS sequence_in_cluster FROM up LEFT JOIN l ON l.cell = up.cell AND l.child = up.root WHERE l.child IS NULL""",
    "poisson_fit": f"{_noise().replace('WITH ', 'WITH RECURSIVE ', 1)} {_POISSON}",
    "direct_matches": f"{_direct(1, 0.6, False)} SELECT * FROM direct",
    "direct_matches_weighted": f"{_direct(1, 0.3, True, 3)} SELECT * FROM direct",
    "direct_summary": f"""{_direct(1, 0.6, False)}, b AS (SELECT *, CASE WHEN match_rank = 1 AND matched_barcodes > 0 THEN jaccard_similarity END AS s FROM direct)
SELECT count(s) AS matched, count(*) FILTER (matched_barcodes = 0) AS unmatched, round(avg(s), 6) AS mean, round(median(s), 6) AS median, round(min(s), 6) AS min, round(max(s), 6) AS max FROM b""",
    "clone_groups_cross": f"{_pairs(True, 0)}, {_components('SELECT s1, c1, s2, c2 FROM near', 'SELECT source, cell FROM p0 UNION ALL SELECT source, cell FROM p1')}",
    "few_lineage_clones": f"{_pairs(False, 0)}, {_components('SELECT x.source AS s1, x.cell AS c1, y.source AS s2, y.cell AS c2 FROM p0 x JOIN p0 y ON x.barcode = y.barcode AND x.cell < y.cell AND x.n < 20 AND y.n < 20', 'SELECT source, cell FROM p0 WHERE n < 20')}",
    "hub_cells": f"{_pairs(False)} {_GROUPS} SELECT * FROM groups WHERE degree > 1",
    "clone_size_histogram": f"{_pairs(False)} {_GROUPS} SELECT clone_size, count(*) AS clones FROM sizes GROUP BY 1",
    "all_pairs_within": _every(False),
    "all_pairs_cross": _every(True),
    "fastq_records": f"WITH {READS}, mates AS ({fx.MATES}) SELECT row_number() OVER (ORDER BY number, seq1, seq2) - 1 AS ord, id1, seq1, id2, seq2 FROM mates",
    "fastq_extract": f"WITH {READS} SELECT readid, cell_barcode, umi, b AS lineage_barcode, {_LONG_WSN} AS mismatches FROM (SELECT *, {fx.LONG_BARCODE} AS b FROM reads WHERE readid::BIGINT % 11 <> 0 AND readid::BIGINT % 13 <> 0 AND readid::BIGINT % 17 <> 0)",
    "extraction_counts": f"""WITH {READS}, x AS (SELECT *, readid::BIGINT % 13 <> 0 AS found, readid::BIGINT % 13 <> 0 AND readid::BIGINT % 17 <> 0 AS whole, readid::BIGINT % 11 <> 0 AS paired, {_LONG_WSN} AS mm FROM (SELECT *, {fx.LONG_BARCODE} AS b FROM reads))
SELECT count(*) AS reads, count(*) FILTER (found) AS with_capture, count(*) FILTER (whole) AS with_barcode, count(*) FILTER (whole AND paired) AS emitted, count(*) FILTER (whole AND mm > 0) AS with_mismatches, count(*) FILTER (whole AND NOT paired) AS unpaired FROM x""",
    "streamed_counts": f"WITH {READS} SELECT cell_barcode, substr(umi, 1, 3) AS umi, lineage_barcode, count(*) AS read_count FROM reads WHERE {_WSN} <= 0 GROUP BY ALL",
    "addresses_file": f"WITH {READS} SELECT readid, cell_barcode, umi, lineage_barcode, {_WSN} AS mismatches FROM reads",
    "molecules_file": f"{_mol()} SELECT * FROM molecules",
    "corrections_file": f"{_mol()}, {_UMI} SELECT cellbc AS cell_barcode, concat('A', substr(lineage_barcode, 2)) AS canonical_sequence, lineage_barcode AS sequence_in_cluster FROM u WHERE lineage_barcode LIKE 'G%'",
    "whitelist_file": fx.sql(fx.WHITELIST),
    "allow_list_file": f"{fx.sql(fx.ALLOWED)} UNION ALL {fx.sql(fx.ALLOWED)}",
    "counts_file": f"WITH {READS} {fx.corrected_sql()}",
    "clones_file": f'{_pairs(False)} {_GROUPS} SELECT DISTINCT "cloneID" AS clone_id, barcode FROM groups JOIN p0 ON p0.cell = groups.cell_barcode',
    "cell_counts": f"{_mol()}, {_TRANSLATED}, k AS (SELECT DISTINCT m.cell_barcode FROM molecules m JOIN w ON m.cell_barcode = w.cell_barcode_feature WHERE w.cell_barcode_gex IN (SELECT cell_barcode_gex FROM al)) SELECT (SELECT count(DISTINCT cell_barcode) FROM molecules) AS before, (SELECT count(*) FROM k) AS after, (SELECT count(DISTINCT cell_barcode) FROM molecules) - (SELECT count(*) FROM k) AS lost",
    "lost_cells": f"{_mol()}, {_TRANSLATED} SELECT DISTINCT cell_barcode FROM molecules WHERE cell_barcode NOT IN (SELECT cell_barcode FROM t)",
    "single_lineage": f"WITH {READS}, k AS ({fx.corrected_sql()}) SELECT avg(CASE WHEN total_lineages_per_cell = 1 THEN 1.0 ELSE 0.0 END) AS single_lineage_fraction FROM k",
    "noise_stats": f"{_noise()} SELECT {_NOISE_COLUMNS} FROM z",
    "noise_filtered": f"{_noise()} SELECT {_NOISE_COLUMNS} FROM f",
    "lineage_hist": f"{_noise()} SELECT lineage_count, count(DISTINCT cell_barcode) AS cells FROM f GROUP BY 1",
    "fuzzy_pairs": f"""WITH {READS}, a AS (SELECT DISTINCT lineage_barcode AS b1 FROM reads WHERE condition = '{T0}'), b AS (SELECT DISTINCT lineage_barcode AS b2 FROM reads WHERE condition = '{TREATED}')
SELECT b1, b2, hamming(b1, b2)::INT AS distance FROM a JOIN b ON hamming(b1, b2) <= 2""",
    "clone_pairs_within": f"{_pairs(False)} SELECT * REPLACE (round(mean_match_confidence, 6) AS mean_match_confidence) FROM pairs",
    "clone_pairs_full": f"{_pairs(False, 1, False)} SELECT * REPLACE (round(mean_match_confidence, 6) AS mean_match_confidence) FROM pairs",
    "clone_pairs_cross": f"{_pairs(True)} SELECT * REPLACE (round(mean_match_confidence, 6) AS mean_match_confidence) FROM pairs",
    "clone_groups": f"{_pairs(False)} {_GROUPS} SELECT * FROM groups",
    "clone_barcodes": f"""{_pairs(False)} {_GROUPS} SELECT "cloneID", count(DISTINCT cell) AS count, string_agg(DISTINCT barcode, '_' ORDER BY barcode) AS clone_barcode FROM groups JOIN p0 ON p0.cell = groups.cell_barcode GROUP BY 1""",
    "graph_nodes": f"""{_pairs(False)} {_GROUPS} SELECT cell_barcode, source_condition, degree, concat('Clone_', "cloneID") AS assigned_clone_id FROM groups""",
    "graph_edges": f"""{_pairs(False)} SELECT concat(source_condition_1, '|', cell_barcode_1) AS node1, concat(source_condition_2, '|', cell_barcode_2) AS node2, num_matches, num_exact_matches, num_hamming_matches, best_hamming_distance,
  round(mean_match_confidence, 6) AS mean_match_confidence, round(mean_match_confidence, 6) AS edge_weight FROM pairs""",
    "graph_file": f"""{_pairs(False)} SELECT concat(source_condition_1, '|', cell_barcode_1) AS node1, concat(source_condition_2, '|', cell_barcode_2) AS node2, num_matches, num_exact_matches, num_hamming_matches, best_hamming_distance,
  round(mean_match_confidence, 6) AS mean_match_confidence, round(mean_match_confidence, 6) AS edge_weight FROM pairs""",
    "graph_statistics": f"""{_pairs(False)} {_GROUPS} SELECT count(*) AS components, max(clone_size) AS largest, count(*) FILTER (clone_size = 1) AS singletons, sum(clone_size)::BIGINT AS cells, (SELECT count(*) FROM pairs) AS edges FROM sizes""",
    "matched_cells": f"{_pairs(True)} SELECT cell_barcode_1 AS cell_barcode, source_condition_1 AS source_condition FROM pairs UNION SELECT cell_barcode_2, source_condition_2 FROM pairs",
    "legacy_clones": f"""WITH {READS}, k AS ({fx.corrected_sql(T0)}), c AS (SELECT cell_barcode, string_agg(corrected_lineage_barcode, '_' ORDER BY corrected_lineage_barcode) AS clone_barcode FROM k GROUP BY 1),
g AS (SELECT clone_barcode, count(*) AS cells, row_number() OVER (ORDER BY count(*) DESC, clone_barcode) AS "cloneID" FROM c GROUP BY 1) SELECT "cloneID", clone_barcode, cell_barcode, cells FROM c JOIN g USING (clone_barcode)""",
    "ranked_matches": f'{_RANKED} SELECT "T1_clone_id", "T0_clone_id", {_SIM}, {_COUNTS}, match_rank::INT AS match_rank FROM ranked',
    "ranked_matches_weighted": f'{_RANKED} SELECT "T1_clone_id", "T0_clone_id", {_SIM}, round(umi_weighted_score, 6) AS umi_weighted_score, {_COUNTS}, match_rank::INT AS match_rank FROM ranked',
    "best_matches": f'{_RANKED} SELECT "T1_clone_id", "T0_clone_id", {_SIM}, {_COUNTS} FROM ranked WHERE match_rank = 1',
    "clone_map_file": f'{_RANKED} SELECT "T1_clone_id", "T0_clone_id" FROM ranked WHERE match_rank = 1',
    "unmatched_clones": f"""{_RANKED} SELECT "T1_clone_id", "T0_clone_id", {_SIM} FROM ranked WHERE match_rank = 1 AND similarity_score < 0.8
UNION ALL SELECT DISTINCT clone_id, NULL::BIGINT, 0.0 FROM x1 WHERE clone_id NOT IN (SELECT "T1_clone_id" FROM ranked)""",
    "match_statistics": f"""{_RANKED}, b AS (SELECT n.clone_id, similarity_score AS s FROM ranked_n1 n LEFT JOIN ranked ON n.clone_id = "T1_clone_id" AND match_rank = 1)
SELECT count(*) AS t1_clones, count(s) AS with_candidates, count(*) FILTER (s >= 0.8) AS matched, round(avg(s), 6) AS mean_similarity, round(median(s), 6) AS median_similarity, round(stddev_pop(s), 6) AS std_similarity, round(min(s), 6) AS min_similarity, round(max(s), 6) AS max_similarity FROM b""",
    "similarity_histogram": f"{_RANKED} SELECT least(floor(similarity_score * 50), 49)::INT AS bin, count(*) AS clones FROM ranked WHERE match_rank = 1 GROUP BY 1",
    "matched_sizes": f'{_RANKED} SELECT "num_T0_barcodes", "num_T1_barcodes", count(*) AS clones, round(avg(similarity_score), 6) AS similarity_score FROM ranked WHERE match_rank = 1 AND similarity_score >= 0.5 GROUP BY 1, 2',
    "top_match_cells": f"""{_RANKED}, t AS (SELECT "T1_clone_id" FROM ranked WHERE match_rank = 1 ORDER BY similarity_score DESC, "T1_clone_id" LIMIT 30) SELECT "T1_clone_id", "T0_clone_id", {_SIM} FROM ranked WHERE "T1_clone_id" IN (FROM t)""",
    "direct_exact": f"{_EXACT} SELECT * FROM x",
    "matches_file": f"""{_EXACT} SELECT "T0_cell_barcode", "T1_cell_barcode", "T1_barcode_count"::VARCHAR AS "T1_barcode_count", matched_barcodes::VARCHAR AS matched_barcodes, printf('%.6f', jaccard_similarity) AS jaccard_similarity, match_rank::VARCHAR AS match_rank FROM x""",
    "clone_sizes": f"WITH {READS}, {_cells('x0', T0)}, w AS (SELECT barcode, sum(umi_count) AS w FROM x0 GROUP BY 1) SELECT clone_id, sum(w)::BIGINT AS size FROM x0 JOIN w USING (barcode) GROUP BY 1",
    "enrichment_results": f"""{_ENRICHED} SELECT "Clone_ID", "T0_size", "Control_size", "Treated_size", round("FC_control", 6) AS "FC_control", round("FC_treated", 6) AS "FC_treated", round("Log2_FC_ratio", 6) AS "Log2_FC_ratio", round(p_value, 6) AS p_value, round(q_value, 6) AS q_value, "Status" FROM res""",
    "top_changed": f"""{_ENRICHED} SELECT "Clone_ID", "T0_size", "Control_size", "Treated_size", round("FC_control", 6) AS "FC_control", round("FC_treated", 6) AS "FC_treated", round("Log2_FC_ratio", 6) AS "Log2_FC_ratio", round(p_value, 6) AS p_value, round(q_value, 6) AS q_value, "Status"
  FROM res WHERE "Status" <> 'Neutral' QUALIFY row_number() OVER (PARTITION BY "Status" ORDER BY CASE WHEN "Status" = 'Depleted' THEN "Log2_FC_ratio" ELSE -"Log2_FC_ratio" END, "Clone_ID") <= 10""",
    "plot_points": f"""{_ENRICHED} SELECT "Clone_ID", "Status", round("Log2_FC_ratio", 6) AS "Log2_FC_ratio", round(-log10(greatest(q_value, 1e-300)) + 0.0, 6) + 0.0 AS neg_log10_q, round(log2(greatest(("Control_size" + "Treated_size") / 2, 0.5)), 6) AS mean_log2_size,
  round(log2(greatest("FC_control", 1e-10)), 6) AS log2_fc_control, round(log2(greatest("FC_treated", 1e-10)), 6) AS log2_fc_treated, round(log2("T0_size" + 1.0), 6) AS log2_t0, round(log2("Control_size" + 1.0), 6) AS log2_control, round(log2("Treated_size" + 1.0), 6) AS log2_treated FROM res""",
    "ratio_histogram": f"""{_ENRICHED}, w AS (SELECT min("Log2_FC_ratio") AS lo, CASE WHEN max("Log2_FC_ratio") = min("Log2_FC_ratio") THEN 1.0 ELSE (max("Log2_FC_ratio") - min("Log2_FC_ratio")) / 80 END AS width FROM res)
SELECT least(floor(("Log2_FC_ratio" - lo) / width), 79)::INT AS bin, count(*) AS clones FROM res, w GROUP BY 1""",
    "barcode_sizes": f"WITH {READS}, {_cells('x0', T0)} SELECT clone_id, count(DISTINCT barcode) AS size FROM x0 GROUP BY 1",
    "enrichment_summary": f"""{_ENRICHED} SELECT count(*) AS clones, count(*) FILTER ("Status" = 'Enriched') AS enriched, count(*) FILTER ("Status" = 'Depleted') AS depleted, count(*) FILTER ("Status" = 'Neutral') AS neutral,
  round(avg("Log2_FC_ratio"), 6) AS mean, round(median("Log2_FC_ratio"), 6) AS median, round(stddev_samp("Log2_FC_ratio"), 6) AS std, round(min("Log2_FC_ratio"), 6) AS min, round(max("Log2_FC_ratio"), 6) AS max,
  count(*) FILTER ("Control_size" = 0) AS absent_control, count(*) FILTER ("Treated_size" = 0) AS absent_treated, count(*) FILTER ("Control_size" = 0 AND "Treated_size" = 0) AS absent_both FROM res""",
    "fisher_test": f"""WITH c AS (SELECT l_suppkey, count(*) FILTER (l_returnflag = '{T0}') AS a, count(*) FILTER (l_returnflag = '{CONTROL}') AS b, count(*) FILTER (l_returnflag = '{TREATED}') AS c FROM lineitem GROUP BY 1),
p AS (SELECT *, {_fisher("(a + 1)", "(b + 1)", "(a + 1)", "(c + 1)")} AS p_value FROM c), q AS (SELECT *, row_number() OVER (ORDER BY p_value) AS r, count(*) OVER () AS m FROM p)
SELECT l_suppkey, a, b, c, round(p_value, 6) AS p_value, round({_BH}, 6) AS q_value FROM q""",
    "cumulative_hist": f"""WITH {READS}, c AS (SELECT cell_barcode AS barcode, count(*) AS molecules, count(DISTINCT lineage_barcode) AS genes FROM reads GROUP BY 1)
SELECT barcode, molecules, genes, round(sum(molecules) OVER w / sum(molecules) OVER (), 6) AS cum_fraction, round(avg(molecules) OVER w, 6) AS mean_molecules, round(avg(genes) OVER w, 6) AS mean_genes FROM c WINDOW w AS (ORDER BY molecules DESC, barcode ROWS UNBOUNDED PRECEDING)""",
    "retention": f"WITH {READS} SELECT count(*) AS original, count(*) FILTER ({_WSN} <= 0) AS processed, round(count(*) FILTER ({_WSN} <= 0) / count(*) * 100, 6) AS percent FROM reads",
    "match_confidences": f"""WITH {READS}, k0 AS ({fx.corrected_sql(T0)}), k1 AS ({fx.corrected_sql(TREATED)})
SELECT cell_barcode, corrected_lineage_barcode, round(0.7 * least(k0.umi_count, k1.umi_count) / greatest(k0.umi_count, k1.umi_count) + 0.3 / (1 + abs(k0.total_lineages_per_cell - k1.total_lineages_per_cell)), 6) AS confidence FROM k0 JOIN k1 USING (cell_barcode, corrected_lineage_barcode)""",
    "hamming_distances": f"WITH w AS ({fx.sql(fx.WHITELIST)}) SELECT *, hamming(cell_barcode_gex, cell_barcode_feature)::INT AS distance, 16 AS unequal FROM w",
}
