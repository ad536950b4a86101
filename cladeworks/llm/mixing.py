"""Mixing sources to target weights with native DataFrame operations.

Rows get a hash-random key, are ranged by it within their source, and a prefix sum of words over the
ranges and inside each range finds where the source's budget is spent. Whole epochs come first.

Defined results: a null text has size 0; a null source is a source of its own and comes last; sources
without words get target 0; rows of equal source, key and size (repeats of a document) share the cut
evenly, rounded down; an empty table gives an empty result. Helper columns carry the prefix ``_mx_``,
so other columns of the input pass through untouched; ``mixed_documents`` takes columns of any name. Texts of any
length are counted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeworks.llm.columns import apart
from cladeworks.runtime import materialize, read_table, sized

SEED = "mix-1"
#: Most that a source, and so a document, is repeated.
MAX_EPOCHS = 3
#: Rows in a key range of a source, on average; one task's window never holds much more.
RANGE_ROWS = 1_000
WORD = r"[^\x20\x09-\x0D]++"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, size: Column) -> Column:
    """60 bits of MD5 over seed, id and size."""
    label = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), size.cast("string"))
    return F.conv(F.substring(F.md5(label), 1, 15), 16, 10).cast("long")


def source_targets(rows: DataFrame) -> DataFrame:
    """Per source: rows, words, weight, target. One row a source; capped targets are refilled by weight.

    With caps c and weights w, sources in the order of c / w fill up one after another while their cap
    is below their share of what is left; the first that does not fill fixes the level of the rest.
    """
    per = rows.groupBy("_mx_null", "_mx_source").agg(F.count("*").alias("_mx_rows"), F.sum("_mx_size").alias("_mx_words"))
    by_name = Window.orderBy("_mx_null", "_mx_source")
    per = per.withColumn("_mx_weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
    per = per.withColumn("_mx_cap", F.col("_mx_words") * float(MAX_EPOCHS))
    fill = Window.orderBy(F.col("_mx_cap") / F.col("_mx_weight"), "_mx_null", "_mx_source")
    before, onward = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("_mx_words").over(Window.partitionBy()).cast("double")
    per = per.withColumn("_mx_level", (total - F.coalesce(F.sum("_mx_cap").over(before), F.lit(0.0))) / F.sum("_mx_weight").over(onward))
    per = per.withColumn("_mx_open", F.col("_mx_cap") > F.col("_mx_level") * F.col("_mx_weight")).withColumn("_mx_nth", F.row_number().over(fill))
    level = F.min_by(F.when(F.col("_mx_open"), F.col("_mx_level")), F.when(F.col("_mx_open"), F.col("_mx_nth"))).over(Window.partitionBy())
    target = F.when(level.isNull(), F.col("_mx_cap")).otherwise(F.least("_mx_cap", level * F.col("_mx_weight")))
    return per.select("_mx_null", "_mx_source", "_mx_rows", "_mx_words", target.alias("_mx_target"))


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    keyed = docs.withColumn("_mx_size", word_count(F.col(text_col)))
    return keyed.withColumns({
        "_mx_null": F.col(source_col).isNull(),
        "_mx_source": F.coalesce(F.col(source_col), F.lit("")),
        "_mx_key": random_key(F.col(id_col), F.col("_mx_size")),
    })


def plan_cuts(narrow: DataFrame) -> DataFrame:
    """One row a source: target, whole epochs, and the key and share at which the last epoch is cut."""
    targets = materialize(source_targets(narrow))
    on = ["_mx_null", "_mx_source"]
    ranged = narrow.join(sized(targets), on)
    ranges = F.ceil(F.col("_mx_rows") / RANGE_ROWS).cast("long")
    ranged = ranged.withColumn("_mx_range", F.shiftright(F.shiftright("_mx_key", 30) * ranges, 30))
    # Rows with one key are one group, so no order among equals is needed.
    groups = ranged.groupBy(*on, "_mx_range", "_mx_key", "_mx_size").agg(F.count("*").alias("_mx_equal"))
    groups = groups.withColumn("_mx_sum", F.col("_mx_equal") * F.col("_mx_size"))
    sums = groups.groupBy(*on, "_mx_range").agg(F.sum("_mx_sum").alias("_mx_in_range"))
    ahead = Window.partitionBy(*on).orderBy("_mx_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_mx_ahead", F.coalesce(F.sum("_mx_in_range").over(ahead), F.lit(0)))
    inside = Window.partitionBy(*on, "_mx_range").orderBy("_mx_key", "_mx_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.withColumn("_mx_within", F.coalesce(F.sum("_mx_sum").over(inside), F.lit(0)))
    placed = placed.join(sums, [*on, "_mx_range"]).join(sized(targets), on)
    budget = F.floor("_mx_target").cast("long")
    epochs = F.when(F.col("_mx_words") > 0, F.floor(budget / F.col("_mx_words"))).otherwise(0).cast("long")
    placed = placed.withColumn("_mx_rest", budget - epochs * F.col("_mx_words")).withColumn("_mx_start", F.col("_mx_ahead") + F.col("_mx_within"))
    hit = placed.where("_mx_rest > _mx_start and _mx_rest <= _mx_start + _mx_sum")
    cut = hit.select(*on, F.col("_mx_key").alias("_mx_cut_key"), F.col("_mx_size").alias("_mx_cut_size"), F.floor((F.col("_mx_rest") - F.col("_mx_start")) / F.col("_mx_equal")).cast("long").alias("_mx_share"))
    return materialize(targets.withColumn("_mx_epochs", epochs).join(cut, on, "left"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` with ``_mx_size``, ``_mx_words`` (of the source), ``_mx_target`` and ``_mx_taken``."""
    keyed = _keyed(docs, id_col, text_col, source_col)
    narrow = materialize(keyed.select("_mx_null", "_mx_source", "_mx_key", "_mx_size"))
    return _decide(keyed, plan_cuts(narrow))


def _decide(keyed: DataFrame, cuts: DataFrame) -> DataFrame:
    out = keyed.join(sized(cuts), ["_mx_null", "_mx_source"])
    here, at = F.struct("_mx_key", "_mx_size"), F.struct("_mx_cut_key", "_mx_cut_size")
    part = F.when(F.col("_mx_cut_key").isNull(), 0).when(here < at, F.col("_mx_size")).when(here == at, F.col("_mx_share")).otherwise(0)
    return out.withColumn("_mx_part", part.cast("long")).withColumn("_mx_taken", F.col("_mx_epochs") * F.col("_mx_size") + F.col("_mx_part"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", chars_col: str = "n_chars") -> DataFrame:
    """The mix itself: a row for each time a document is taken, in the columns of ``docs``.

    The document at the cut comes with its first words only. Documents without words stay once, as
    they cost nothing.
    """
    return apart(docs, _mixed, id_col=id_col, text_col=text_col, source_col=source_col, chars_col=chars_col)


def _mixed(docs: DataFrame, id_col: str, text_col: str, source_col: str, chars_col: str) -> DataFrame:
    taken = mix(docs, id_col, text_col, source_col)
    first = F.concat(F.lit(r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){"), F.col("_mx_part").cast("string"), F.lit("}+"))
    head = F.call_function("regexp_extract", F.col(text_col), first, F.lit(0))
    whole = F.when(F.col("_mx_size") == 0, 1).otherwise(F.col("_mx_epochs") + (F.col("_mx_part") == F.col("_mx_size")).cast("long"))
    cut = (F.col("_mx_part") > 0) & (F.col("_mx_part") < F.col("_mx_size"))
    copies = F.concat(F.array_repeat(F.lit(False), whole.cast("int")), F.when(cut, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))
    rows = taken.withColumn("_mx_cut", F.explode(copies))
    rows = rows.withColumn(text_col, F.when(F.col("_mx_cut"), head).otherwise(F.col(text_col)))
    if chars_col in docs.columns:
        rows = rows.withColumn(chars_col, F.when(F.col("_mx_cut"), F.length(text_col).cast("long")).otherwise(F.col(chars_col)))
    return rows.select(*docs.columns)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    keyed = materialize(_keyed(docs, "doc_id", "text", "source").select("doc_id", "_mx_null", "_mx_source", "_mx_key", "_mx_size"))
    mixed = _decide(keyed, plan_cuts(keyed.drop("doc_id")))
    return mixed.select("doc_id", F.col("_mx_size").alias("size"), F.col("_mx_words").alias("source_size"), F.col("_mx_target").alias("target"), F.col("_mx_taken").alias("taken"))


SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
k AS (SELECT *, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || size::VARCHAR), 1, 15))::BIGINT AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS words, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w FROM k GROUP BY source),
f AS (SELECT *, {MAX_EPOCHS}.0::DOUBLE * words AS cap, row_number() OVER (ORDER BY words / w, source NULLS LAST) AS nth FROM s),
l AS (SELECT *, ((sum(words) OVER ())::DOUBLE - coalesce(sum(cap) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f),
o AS (SELECT *, min_by(level, nth) FILTER (cap > level * w) OVER () AS fixed FROM l),
t AS (SELECT source, words, CASE WHEN fixed IS NULL THEN cap ELSE least(cap, fixed * w) END AS target FROM o),
b AS (SELECT *, floor(target)::BIGINT AS budget, CASE WHEN words > 0 THEN floor(target)::BIGINT // words ELSE 0 END AS epochs FROM t),
g AS (SELECT k.*, b.words, b.target, b.epochs, b.budget - b.epochs * b.words AS rest,
  coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, size RANGE UNBOUNDED PRECEDING), 0) - sum(size) OVER (PARTITION BY k.source, key, size) AS start,
  count(*) OVER (PARTITION BY k.source, key, size) AS equal
  FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, words AS source_size, target,
  (epochs * size + CASE WHEN rest <= start THEN 0 WHEN rest >= start + equal * size THEN size ELSE (rest - start) // equal END)::BIGINT AS taken
FROM g
"""
