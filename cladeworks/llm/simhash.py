"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Two 64-bit fingerprints at no more than 3 differing bits agree in at least 5 of their 8 bytes. The index
has a posting for each of 14 choices of 4 byte positions and their values; among any 5 positions lies one
of the choices, so linked fingerprints meet. Within a posting, pairs tally their shared positional bytes;
those that reach the guaranteed 5 are verified bit by bit. A posting's links are given as a spanning
forest, so a dense one costs rows in proportion to its members and still loses no connection.

Defined results: null and empty texts have no words and fingerprint zero, which links like any other;
one or two words are one shingle; repeated rows share a fingerprint and a component; a repeated doc_id with
different texts is a document for each text, in the component of that text; a null doc_id is
kept and does not name a component unless no other id is there; an empty table gives an empty result; texts of any
length are hashed whole; only id and text are read, and ``deduplicate`` takes columns of any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.columns import apart
from cladeworks.operators.components import connected_components
from cladeworks.runtime import materialize, read_table, sized

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
BYTES = 8
#: Bytes that two linked fingerprints share at least.
SHARED_BYTES = BYTES - MAX_BITS
#: The least number of choices of 4 positions that any 5 of the 8 hold one of.
POSITIONS = [
    (0, 1, 2, 4), (0, 1, 3, 5), (0, 1, 6, 7), (0, 2, 3, 6), (0, 2, 5, 7), (0, 3, 4, 7), (0, 4, 5, 6),
    (1, 2, 3, 7), (1, 2, 5, 6), (1, 3, 4, 6), (1, 4, 5, 7), (2, 3, 4, 5), (2, 4, 6, 7), (3, 5, 6, 7),
]
MASKS = np.array([sum(0xFF << (8 * p) for p in chosen) for chosen in POSITIONS], dtype=np.uint64)
#: Postings up to this size compare members with each other; beyond, each member looks its neighbours up.
BLOCK = 4096
#: Shingle hashes turned into bits at once.
CHUNK = 1 << 15


def fingerprint(text: str | None) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six white-space bytes only
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS)))) if len(words) >= SHINGLE_WORDS else [b" ".join(words)]
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        part = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = np.fromiter((fingerprint(t.as_py()) for t in batch.column(0)), dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(marks.view(np.int64))], [*batch.schema.names[1:], "_sh_fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """``(_sh_id, _sh_fp)`` a row, with ``more`` between them; the fingerprint is the signed reading of the 64 bits."""
    rows = docs.select(F.col(text_col).alias("_sh_text"), F.col(id_col).cast("long").alias("_sh_id"), *more)
    return rows.mapInArrow(_fingerprints, rows.drop("_sh_text").schema.add("_sh_fp", "long"))


def shared_bytes(apart: np.ndarray) -> np.ndarray:
    """Positional bytes that are equal, from the differing bits of pairs."""
    return (np.ascontiguousarray(apart).view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)


def _linked(apart: np.ndarray) -> np.ndarray:
    """Count filter, then the bits of the pairs that it leaves."""
    near = shared_bytes(apart) >= SHARED_BYTES
    near[near] = np.bitwise_count(apart[near]) <= MAX_BITS
    return near


def spanning_links(members: np.ndarray, chosen: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A spanning forest of the links among the distinct fingerprints of one posting."""
    if len(members) > BLOCK:
        return _spanning_by_lookup(members, chosen)
    tails, heads, left = [], [], members
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = _linked(left ^ at)
            if near.any():
                found = left[near]
                tails.append(np.full(len(found), at))
                heads.append(found)
                frontier.extend(found)
                left = left[~near]
    return tails, heads


def _spanning_by_lookup(members: np.ndarray, chosen: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    free = [b for b in range(64) if not (int(MASKS[chosen]) >> b) & 1]
    flips = np.array([sum(1 << b for b in bits) for k in range(1, MAX_BITS + 1) for bits in combinations(free, k)], dtype=np.uint64)
    members = np.sort(members)
    tails, heads, seen = [], [], np.zeros(len(members), dtype=bool)
    for start in range(len(members)):
        if seen[start]:
            continue
        seen[start], frontier = True, [start]
        while frontier:
            at = members[frontier.pop()]
            wanted = flips ^ at
            where = np.minimum(np.searchsorted(members, wanted), len(members) - 1)
            found = where[(members[where] == wanted) & ~seen[where]]
            if len(found):
                seen[found] = True
                tails.append(np.full(len(found), at))
                heads.append(members[found])
                frontier.extend(found.tolist())
    return tails, heads


def _posting_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by posting; the last, perhaps unfinished posting of a batch waits for the next."""
    kept_c, kept_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def links(c: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        key = f & MASKS[c]
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (c[1:] != c[:-1])])
        sizes = np.diff(np.r_[starts, len(c)])
        twos = starts[sizes == 2]
        near = _linked(f[twos] ^ f[twos + 1])
        tails, heads = [f[twos][near]], [f[twos + 1][near]]
        for at, n in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            t, h = spanning_links(f[at : at + n], int(c[at]))
            tails += t
            heads += h
        a, b = np.concatenate(tails).view(np.int64), np.concatenate(heads).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["src", "dst"])

    for batch in batches:
        c = np.concatenate([kept_c, batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)])
        f = np.concatenate([kept_f, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(c):
            continue
        key = f & MASKS[c]
        open_ = np.flatnonzero((key != key[-1]) | (c != c[-1]))
        cut = int(open_[-1]) + 1 if len(open_) else 0
        if cut:
            yield links(c[:cut], f[:cut])
        kept_c, kept_f = c[cut:], f[cut:]
    if len(kept_c):
        yield links(kept_c, kept_f)


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """``(src, dst)`` over the distinct ``_sh_fp`` of the input: links that connect what is linked."""
    masks = F.array(*[F.lit(int(m)) for m in MASKS.view(np.int64)])
    chosen = F.explode(F.array(*[F.lit(i).cast("byte") for i in range(len(POSITIONS))]))
    index = distinct.select(chosen.alias("c"), F.col("_sh_fp").alias("f"))
    key: Column = F.col("f").bitwiseAND(F.element_at(masks, F.col("c").cast("int") + 1))
    postings = index.repartition(F.col("c"), key).sortWithinPartitions(F.col("c"), key, F.col("f"))
    return postings.mapInArrow(_posting_links, "src long, dst long").distinct()


def _components(marked: DataFrame) -> DataFrame:
    """``marked`` with ``_sh_part``, the component's least fingerprint, and ``_sh_component``, its smallest id."""
    least = materialize(marked.groupBy("_sh_fp").agg(F.min("_sh_id").alias("_sh_least")))
    parts = connected_components(fingerprint_links(least)).toDF("_sh_fp", "_sh_part")
    named = least.join(parts, "_sh_fp", "left").withColumn("_sh_part", F.coalesce("_sh_part", "_sh_fp"))
    names = named.groupBy("_sh_part").agg(F.min("_sh_least").alias("_sh_component"))
    class_of = materialize(named.join(names, "_sh_part").select("_sh_fp", "_sh_part", "_sh_component"))
    return marked.join(class_of, "_sh_fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_sh_id, _sh_fp, _sh_component)`` for each row of ``docs``."""
    return _components(materialize(fingerprints(docs, id_col, text_col))).select("_sh_id", "_sh_fp", "_sh_component")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component; rows without an id stay.

    It is the row of the smallest id; where an id is there more than once, of those the least by text hash
    and then row hash. The same id may stay for several components.
    """
    return apart(docs, _deduplicated, id_col=id_col, text_col=text_col)


def _deduplicated(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    values = [F.col(c) for c in docs.columns]
    row = F.struct(F.xxhash64(F.col(text_col)).alias("text"), F.xxhash64(*values, *[c.isNull() for c in values]).alias("row"))
    classes = materialize(_components(materialize(fingerprints(docs, id_col, text_col, row.alias("_sh_row")))))
    first = classes.where("_sh_id = _sh_component").groupBy("_sh_part").agg(F.min("_sh_row").alias("_sh_first"), F.count("*").alias("n"))
    several = materialize(first.where("n > 1").select("_sh_part", "_sh_first"))
    other = F.col("_sh_id") != F.col("_sh_component")
    if several.limit(1).count():
        classes = classes.join(sized(several), "_sh_part", "left")
        other = other | (F.col("_sh_id").isNotNull() & F.coalesce(F.col("_sh_row") != F.col("_sh_first"), F.lit(False)))
    dropped = classes.where(other).select(F.col("_sh_id").alias(id_col), "_sh_row").distinct()
    keyed = docs.withColumn("_sh_row", row)
    kept = keyed.join(dropped, [id_col, "_sh_row"], "left_anti")
    if several.limit(1).count():  # rows that are equal in all columns
        kept = kept.where(F.col(id_col).isNotNull()).dropDuplicates([id_col, "_sh_row"]).unionByName(kept.where(F.col(id_col).isNull()))
    return kept.select(*docs.columns)


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("_sh_id").alias("doc_id"), F.lower(F.lpad(F.hex("_sh_fp"), 16, "0")).alias("fingerprint"), F.col("_sh_component").alias("component_id"))
