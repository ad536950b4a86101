"""Audit of how ordered quality filters interact: an incidence matrix product over histograms of failing filters.

A document's outcome under any order of the filters depends only on the set of filters that it fails, its
mask. So documents are counted once by part and mask (all, labelled good, labelled toxic), and each part's
three histograms are rows of 32 columns. Every order and step is a column of integer incidence matrices, 32 by 600
for five filters, that say which masks are kept, removed, redundant or unique there; rows times matrices are
all counts of all orders at once. The Shapley value of a filter is its removed count over all orders.

Filters, by letter: A too few words, B too few distinct words, C too many capitals, D a symbol, E the same text as
a smaller id anywhere in the table. Copies of a text are counted by part and label before they meet, so a group
of any size adds a row for each of its parts and labels.

Defined results: a null text is empty, and so the same as other empty texts; a null part is the empty string and joins the
documents of that name; rows without an id never fail E and make no other fail it; of rows with one id and
one text none is smaller; a document counts as good or toxic if any row of ``labels`` of its id says so; repeated rows
count each; texts of any length are read whole; an empty table has no parts and gives no rows. Only the
columns named are read, so others cannot clash.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeworks.runtime import read_table

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
SYMBOLS = "[#$%&*|]"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
#: Parts multiplied at once.
PART_ROWS = 256
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def incidence() -> dict[str, np.ndarray]:
    """Integer matrices of masks by (order, step): whether a mask is kept, removed, redundant or fails there alone."""
    masks = np.arange(1 << len(FILTERS))
    shape = (len(masks), len(ORDERS), len(FILTERS))
    out = {name: np.zeros(shape, dtype=np.int64) for name in ("kept", "removed", "redundant", "unique_fails")}
    for o, order in enumerate(ORDERS):
        alive = np.ones(len(masks), dtype=bool)
        for s, letter in enumerate(order):
            bit = 1 << FILTERS.index(letter)
            fails = (masks & bit) > 0
            out["removed"][:, o, s] = alive & fails
            out["redundant"][:, o, s] = ~alive & fails
            out["unique_fails"][:, o, s] = masks == bit
            alive &= ~fails
            out["kept"][:, o, s] = alive
    return {name: m.reshape(len(masks), -1) for name, m in out.items()}


def text_mask(text: Column) -> Column:
    """Bits of the filters that a text fails by itself, A to D. Only the five white space characters and the space part words."""
    words = F.array_remove(F.split(F.translate(text, "\t\n\x0b\f\r", "     "), " "), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = [
        n < MIN_WORDS,
        100 * distinct < DISTINCT_PERCENT * n,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > CAPITAL_PERCENT * F.length(text),
        text.rlike(SYMBOLS),
    ]
    bits = [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)]
    return sum(bits[1:], bits[0])


def mask_histograms(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Documents by part and mask: ``n`` all, ``good`` and ``toxic`` labelled ones; at most 32 rows a part."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("copy"), text_mask(text).alias("mask"))
    rows = rows.groupBy("id", "copy", "mask", "part").agg(F.count("*").alias("n"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marks = marks.where("good = 1 or toxic = 1").select(F.col("id").alias("at"), "id", "good", "toxic")
    # Rows without an id have no label; their hash deals them out.
    keyed = rows.withColumn("at", F.coalesce("id", F.xxhash64("copy")))
    marked = keyed.join(marks, ["at", "id"], "left").fillna(0, ["good", "toxic"])
    # Copies of one part and label differ only in whether they hold the smallest id of all copies.
    named = F.col("id").isNotNull()
    copies = marked.groupBy("copy", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("first"), F.min_by("n", "id").alias("at_first"), F.sum(F.when(named, 0).otherwise(F.col("n"))).alias("nameless")
    )
    smallest = F.min("first").over(Window.partitionBy("copy"))
    passing = F.col("nameless") + F.when(F.col("first") == smallest, F.col("at_first")).otherwise(0)
    copies = copies.withColumn("passing", passing)
    fails = F.lit(1 << FILTERS.index("E"))
    both = F.array(F.struct("mask", F.col("passing").alias("n")), F.struct((F.col("mask") + fails).alias("mask"), (F.col("n") - F.col("passing")).alias("n")))
    counted = copies.select("part", "good", "toxic", F.inline(both))
    return counted.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def outcomes(histograms: DataFrame) -> DataFrame:
    """A row for each part, order and step, from the histograms times the incidence matrices."""
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
    by_part = histograms.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("bins"))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = incidence()
        letters = np.array([[FILTERS.index(x) for x in order] for order in ORDERS]).ravel()
        same_filter = np.eye(len(FILTERS), dtype=np.int64)[letters]
        for batch in batches:
            for at in range(0, batch.num_rows, PART_ROWS):
                names, bins = (column.slice(at, PART_ROWS) for column in batch.columns)
                row = np.repeat(np.arange(len(names)), np.diff(bins.offsets))
                mask, *values = (column.to_numpy() for column in bins.flatten().flatten())
                stacked = np.zeros((3, len(names), 1 << len(FILTERS)), dtype=np.int64)
                for histogram, value in zip(stacked, values, strict=True):
                    histogram[row, mask] = value
                docs, good, toxic = stacked
                removed = docs @ matrix["removed"]
                counts = {name: docs @ m for name, m in matrix.items()} | {"good_lost": good @ matrix["removed"], "toxic_lost": toxic @ matrix["removed"], "shapley": (removed @ same_filter)[:, letters]}
                steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS) * len(names))
                keys = [names.take(pa.array(np.repeat(np.arange(len(names)), len(letters)))), pa.array(np.repeat(ORDERS, len(FILTERS)).tolist() * len(names)), pa.array(steps)]
                yield pa.RecordBatch.from_arrays([*keys, *(pa.array(counts[c].ravel()) for c in COUNTS)], ["part", "filter_order", "step", *COUNTS])

    return by_part.mapInArrow(multiply, schema)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes(mask_histograms(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")))


SQL = rf"""
WITH marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
m AS (SELECT d.part, coalesce(marks.good, 0) AS good, coalesce(marks.toxic, 0) AS toxic,
  (CASE WHEN len(words) < {MIN_WORDS} THEN 1 ELSE 0 END
  + CASE WHEN 100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words) THEN 2 ELSE 0 END
  + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {CAPITAL_PERCENT} * length(text) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(text, '{SYMBOLS}') THEN 8 ELSE 0 END
  + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END)::INT AS mask
  FROM d LEFT JOIN marks USING (doc_id)),
h AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
o AS (SELECT unnest([{", ".join(f"'{x}'" for x in ORDERS)}]) AS filter_order),
s AS (SELECT filter_order, step::INT AS step, 1 << (ascii(substr(filter_order, step::INT, 1)) - 65) AS bit,
  coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(filter_order, i::INT, 1)) - 65))), 0)::INT AS earlier FROM o, range(1, 6) AS t(step)),
r AS (SELECT part, filter_order, step, bit,
  coalesce(sum(n) FILTER (mask & (bit | earlier) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (mask & bit > 0 AND mask & earlier = 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (mask & bit > 0 AND mask & earlier > 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (mask & bit > 0 AND mask & earlier = 0), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (mask & bit > 0 AND mask & earlier = 0), 0)::BIGINT AS toxic_lost
  FROM h, s GROUP BY part, filter_order, step, bit)
SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""
