"""Exact removal of substrings that repeat, by suffix sorting of shards.

A byte is removed if a string of ``WINDOW`` bytes that covers it also starts somewhere else. Every
window of ``WINDOW`` bytes has an anchor, its least-hashed gram of ``GRAM`` bytes; equal windows have
equal anchors at equal offsets. Neighbouring windows with one anchor form a stretch, which goes to the
shard of the anchor's hash, so all equal windows meet in one shard and no shard depends on a document's
size or source. Anchors that occur once cannot repeat and go no further; equal stretches travel once,
with their count; where an anchor's stretches are all of one kind, or all occur again, there is nothing to
compare. Each shard sorts its suffixes by induction (``induced_sorting``) and neighbours in
that order are compared over the whole window, byte for byte. Grouping uses 64-bit hashes of anchors,
64 more bits for stretches, and 128-bit hashes of texts.

Passages of more than 50 words that another document has too are counted beside it, as they may be shorter than
``WINDOW`` bytes: the same stretches are made of words, by windows of ``PASSAGE`` words, and go the same way;
their suffixes are sorted as strings of word hashes. Nothing is removed for them.

Defined results: null and empty texts have no bytes, nothing removed, and the hash of the empty string;
texts under ``WINDOW`` bytes stay whole; of equal windows all are removed, whichever came first; repeated
rows are equal texts, so from ``WINDOW`` bytes on they are removed whole; spans that touch are one span;
copies of a text have its passages; a passage
that only its own document repeats is none; texts of any length are read in chunks that
overlap; an empty table gives an empty result; input columns named like new ones are replaced, others pass through ``remove_repeats``.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.host_text import shared_runs
from cladeworks.llm.induced_sorting import suffix_array
from cladeworks.runtime import materialize, read_table

WINDOW, GRAM = 400, 96
GRAMS = WINDOW - GRAM + 1
#: Bytes whose anchors are found at once; positions in them take 20 bits.
CHUNK = 1 << 19
#: Bytes that a task sorts at once, unless one anchor alone has more.
SHARD_BYTES = 1 << 20
#: Suffixes that wait in memory; the queues of an ordinary shard have more, and go on in a scratch file.
QUEUED = 1 << 18
#: Words of a passage, and of its grams.
PASSAGE, WORD_GRAM = 51, 13
#: A stretch's start, whether it is of words, and its number of windows, in one number.
PLACE_BITS, OF_WORDS, PLACE_LOW = 11, 1024, 1023
LOW = np.uint64((1 << 20) - 1)
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def words_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes that start at each position, as integers."""
    out = np.empty(len(data) - 7, dtype=np.uint64)
    for k in range(8):
        n = (len(data) - k) // 8
        out[k::8] = np.frombuffer(data[k : k + 8 * n].tobytes(), dtype="<u8")[: len(out[k::8])]
    return out


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the ``GRAM`` bytes at each position: of three parts of 32 bytes, by words of 8."""
    x = words_at(data)
    part = x[:-24] * MIX[0] + x[8:-16] * MIX[1] + x[16:-8] * MIX[2] + x[24:] * MIX[3]
    part ^= part >> np.uint64(29)
    h = part[:-64] * MIX[4] + part[32:-32] * MIX[0] + part[64:] * MIX[1]
    h ^= h >> np.uint64(32)
    h *= MIX[3]
    h ^= h >> np.uint64(29)
    return h


def window_anchors(h: np.ndarray, grams: int = GRAMS) -> np.ndarray:
    """For each window of ``grams`` grams, the position of its least gram hash, the first of equals."""
    n = len(h)
    keyed = np.full(-(-n // grams) * grams, np.iinfo(np.uint64).max, dtype=np.uint64)
    keyed[:n] = (h & ~LOW) | np.arange(n, dtype=np.uint64)
    rows = keyed.reshape(-1, grams)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = n - grams + 1
    return (np.minimum(behind[:windows], ahead[grams - 1 : grams - 1 + windows]) & LOW).astype(np.int64)


NOTHING = tuple(np.zeros(0, np.int64) for _ in range(5))


def _cut_stretches(raw: np.ndarray, sizes: np.ndarray, h: np.ndarray, window: int, grams: int) -> tuple[np.ndarray, ...]:
    """Stretches of a chunk of pieces of ``sizes`` symbols, laid end to end in ``raw``: piece number, anchor hash, hash of the stretch, start in the piece, number of windows."""
    ends = np.cumsum(sizes)
    anchor = window_anchors(h, grams)
    at = np.arange(len(anchor))
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(anchor)]
    valid = at + window <= ends[owner]
    turn = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(valid & np.r_[True, turn | ~valid[:-1]])
    stops = np.flatnonzero(valid & np.r_[turn | ~valid[1:], True])
    view, digest, wide = memoryview(raw.view(np.uint8)), xxhash.xxh3_64_intdigest, raw.itemsize
    marks = np.fromiter((digest(view[a:b]) for a, b in zip((heads * wide).tolist(), ((stops + window) * wide).tolist(), strict=True)), dtype=np.uint64, count=len(heads))
    who = owner[heads]
    return who, h[anchor[heads]].view(np.int64), marks.view(np.int64), heads - (ends - sizes)[who], stops - heads + 1


def stretches(pieces: list[bytes]) -> tuple[np.ndarray, ...]:
    """Stretches of bytes of a chunk of pieces."""
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    if len(data) < WINDOW:
        return NOTHING
    return _cut_stretches(data, np.array([len(p) for p in pieces]), gram_hashes(data), WINDOW, GRAMS)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    up, down = (np.full(n, x, dtype=np.uint64) for x in (base, pow(base, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


POWERS = _powers(CHUNK + 1)
#: White space between words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word: polynomial sums over its bytes, differences of prefix sums."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    turn = np.diff(np.r_[True, SPACE[data], True].view(np.int8))
    starts, ends = np.flatnonzero(turn == -1), np.flatnonzero(turn == 1)
    up, down = POWERS if len(data) < len(POWERS[0]) else _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h ^= h >> np.uint64(32)
    h *= MIX[3]
    h ^= h >> np.uint64(29)
    return starts, h


def text_words(data: bytes) -> np.ndarray:
    """Word hashes of a text of any length, read in chunks that end at white space."""
    raw, at, out = np.frombuffer(data, dtype=np.uint8), 0, []
    while at < len(raw):
        end = min(at + CHUNK, len(raw))
        if end < len(raw):
            gap = np.flatnonzero(SPACE[raw[at:end]])
            if len(gap):
                end = at + int(gap[-1]) + 1
            else:  # one word without end: on to the next white space
                while end < len(raw) and not SPACE[raw[end]]:
                    end += 1
        out.append(word_hashes(raw[at:end])[1])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _word_stretches(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    if len(words) < PASSAGE:
        return NOTHING
    h = sum(words[k : len(words) - WORD_GRAM + 1 + k] * np.uint64(2 * k + 1) * MIX[k % len(MIX)] for k in range(WORD_GRAM))
    h ^= h >> np.uint64(32)
    h *= MIX[1]
    h ^= h >> np.uint64(29)
    return _cut_stretches(words, sizes, h, PASSAGE, PASSAGE - WORD_GRAM + 1)


def word_stretches(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Stretches of words of a chunk of whole texts; a text over the chunk's size comes alone."""
    if sum(map(len, texts)) > CHUNK:
        words, parts = text_words(texts[0]), []
        for off in range(0, max(1, len(words) - PASSAGE + 1), CHUNK - PASSAGE + 1):
            piece = words[off : off + CHUNK]
            who, h, g, start, n = _word_stretches(piece, np.array([len(piece)]))
            parts.append((who, h, g, start + off, n))
        return tuple(map(np.concatenate, zip(*parts, strict=True)))
    starts, words = word_hashes(np.frombuffer(b"\n".join(texts), dtype=np.uint8))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return _word_stretches(words, np.diff(np.r_[0, np.searchsorted(starts, bounds)]))


def _squeeze(batches: Iterator[pa.RecordBatch], col: int) -> Iterator[pa.RecordBatch]:
    """Texts are compressed before they are dealt."""
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed = pa.array([squeeze.compress(x.as_buffer()) for x in batch.column(col)], pa.binary())
        yield batch.set_column(col, batch.schema.names[col], packed)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a text and chunk, with the stretches in arrays; start, sort and windows share a number."""

    def emit(rows: list[int], keys: list[np.ndarray], found: tuple[np.ndarray, ...], offsets: np.ndarray, flag: int) -> pa.RecordBatch:
        who, h, g, start, n = found
        place = (start + offsets[who]) << PLACE_BITS | flag | n
        ends = pa.array(np.searchsorted(who, np.arange(len(rows) + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (h, g, place)]
        return pa.RecordBatch.from_arrays([*(pa.array(k[rows]) for k in keys), *lists], ["k1", "k2", "doc", "h", "g", "p"])

    for batch in batches:
        keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3)]
        pieces, rows, offsets, size = [], [], [], 0
        whole, owners, total = [], [], 0
        for row, value in enumerate(batch.column(0)):
            data = value.as_buffer().to_pybytes() if value.is_valid else b""
            for off in range(0, len(data) - WINDOW + 1, CHUNK - WINDOW + 1):
                piece = data[off : off + CHUNK]
                if size + len(piece) > CHUNK:
                    yield emit(rows, keys, stretches(pieces), np.array(offsets, dtype=np.int64), 0)
                    pieces, rows, offsets, size = [], [], [], 0
                pieces.append(piece)
                rows.append(row)
                offsets.append(off)
                size += len(piece)
            if len(data) < 2 * PASSAGE - 1:
                continue
            if total + len(data) + 1 > CHUNK and whole:
                yield emit(owners, keys, word_stretches(whole), np.zeros(len(whole), dtype=np.int64), OF_WORDS)
                whole, owners, total = [], [], 0
            whole.append(data)
            owners.append(row)
            total += len(data) + 1
        if pieces:
            yield emit(rows, keys, stretches(pieces), np.array(offsets, dtype=np.int64), 0)
        if whole:
            yield emit(owners, keys, word_stretches(whole), np.zeros(len(whole), dtype=np.int64), OF_WORDS)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes, or the word hashes, of the stretches that are asked of each text."""
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        for row in range(batch.num_rows):
            asked = batch.column(1)[row].values
            data = expand.decompress(batch.column(0)[row].as_buffer())
            place = asked.field("p").to_numpy()
            of_words, start, n = (place & OF_WORDS) != 0, place >> PLACE_BITS, place & PLACE_LOW
            words = memoryview(text_words(data).astype(np.uint32).view(np.uint8) if of_words.any() else b"")
            stop, wide, view = start + n + np.where(of_words, PASSAGE, WINDOW) - 1, np.where(of_words, 4, 1), memoryview(data)
            cut = [bytes((words if w else view)[a:b]) for w, a, b in zip(of_words.tolist(), (start * wide).tolist(), (stop * wide).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(asked.field(f) for f in SHARED), pa.array(place & (OF_WORDS | PLACE_LOW)), pa.array(cut, pa.binary())], [*SHARED, "n", "data"])


#: Of a distinct stretch: anchor, hash, number of times up to 2, least and greatest document.
SHARED = ["h", "g", "m", "lo", "hi"]


def repeated_windows(data: list[bytes], counts: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each position of the stretches joined by a separator, if a window starts there that occurs more than once."""
    raw = b"\0".join(data)
    text = np.frombuffer(raw, dtype=np.uint8).astype(np.uint16) + 2
    sizes = np.array([len(d) for d in data])
    starts = np.cumsum(sizes + 1) - sizes - 1
    text[starts[1:] - 1] = 1  # separators are less than every byte
    valid, many = np.zeros(len(text), dtype=bool), np.zeros(len(text), dtype=bool)
    for a, n, m in zip(starts.tolist(), windows.tolist(), counts.tolist(), strict=True):
        valid[a : a + n] = True
        many[a : a + n] = m > 1
    order = suffix_array(text, WINDOW, memory=QUEUED)
    order = order[valid[order]]
    words = words_at(np.frombuffer(raw, dtype=np.uint8))
    left = np.flatnonzero(~(many[order[1:]] & many[order[:-1]]))
    # The last words differ most often between neighbours, as these share their beginnings.
    for off in range(WINDOW - 8, -1, -8):
        a, b = order[left] + off, order[left + 1] + off
        left = left[words[a] == words[b]]
        if not len(left):
            break
    out = many
    out[order[left]] = True
    out[order[left + 1]] = True
    return out


def _packed_runs(flags: np.ndarray) -> list[int]:
    turn = np.diff(np.r_[0, flags.view(np.int8), 0])
    return ((np.flatnonzero(turn == 1) << PLACE_BITS) | np.flatnonzero(turn == -1)).tolist()


def _sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor and stretch; whole anchors are sorted together, those of words apart."""
    held: list[tuple] = []
    size, last = 0, None

    def shard() -> pa.RecordBatch:
        out = []
        of_bytes, of_words = ([r for r in held if (r[5] & OF_WORDS != 0) == kind] for kind in (False, True))
        if of_bytes:
            found, at = repeated_windows([r[6] for r in of_bytes], np.array([r[2] for r in of_bytes]), np.array([r[5] for r in of_bytes])), 0
            for h, g, _, _, _, n, data in of_bytes:
                out.append((h, g, _packed_runs(found[at : at + n])))
                at += len(data) + 1
        if of_words:
            bucket = np.unique(np.array([r[0] for r in of_words]), return_inverse=True)[1]
            runs = shared_runs(bucket, [r[6] for r in of_words], *(np.array([r[i] for r in of_words]) for i in (3, 4)), PASSAGE)
            out += [(r[0], r[1], [a << PLACE_BITS | b - PASSAGE + 1 for a, b in pairs]) for r, pairs in zip(of_words, runs, strict=True)]
        columns = list(zip(*[r for r in out if r[2]], strict=True)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)], ["h", "g", "runs"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if last is not None and row[:2] == last:  # a stretch fetched from more than one copy of its text
                continue
            if size >= SHARD_BYTES and row[0] != last[0]:
                yield shard()
                held, size = [], 0
            held.append(row)
            size += len(row[6])
            last = row[:2]
    if held:
        yield shard()


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that are done with."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def covered_ranges(texts: DataFrame) -> DataFrame:
    """``(k1, k2, ranges, passages)``: ranges of bytes to remove, and of words that another document has, for the texts that have any. Input: ``data`` and its key ``k1, k2``."""
    rows = texts.withColumn("doc", F.monotonically_increasing_id())
    found = materialize(rows.mapInArrow(_anchors, "k1 long, k2 long, doc long, h array<long>, g array<long>, p array<long>"))
    names = materialize(found.select("doc", "k1", "k2").distinct())
    kept = _shared_stretches(found)
    del found  # and with it its checkpoint
    release(texts.sparkSession)
    runs = _repeated_runs(texts, names, kept)
    release(texts.sparkSession)
    spans = kept.join(runs, ["h", "g"]).select("doc", (F.col("p").bitwiseAND(OF_WORDS) != 0).alias("words"), F.shiftright("p", PLACE_BITS).alias("start"), F.explode("runs").alias("run"))
    more = F.when(F.col("words"), PASSAGE - 1).otherwise(WINDOW - 1)
    ends = F.struct((F.col("start") + F.shiftright("run", PLACE_BITS)).alias("a"), (F.col("start") + F.col("run").bitwiseAND(PLACE_LOW) + more).alias("b"))
    # collect_set leaves out nulls
    by_doc = spans.groupBy("doc").agg(F.collect_set(F.when(~F.col("words"), ends)).alias("ranges"), F.collect_set(F.when(F.col("words"), ends)).alias("passages"))
    # Copies of a text have equal ranges.
    return materialize(by_doc.join(names, "doc").select("k1", "k2", "ranges", "passages").dropDuplicates(["k1", "k2"]))


def _shared_stretches(found: DataFrame) -> DataFrame:
    """Stretches whose anchor occurs more than once in the corpus."""
    often = found.select(F.explode("h").alias("h")).groupBy("h").agg(F.count("*").alias("all")).where("all > 1").select("h")
    often = materialize(often)  # both sides of a join are then plain exchanges, whose hot keys AQE splits
    each = found.select("doc", F.explode(F.arrays_zip("h", "g", "p")).alias("s")).select("doc", "s.*")
    return materialize(each.join(often, "h").select("doc", "h", "g", "p"))


def _repeated_runs(texts: DataFrame, names: DataFrame, kept: DataFrame) -> DataFrame:
    """Per distinct stretch, the runs of its windows that occur more than once, or of words in more than one document.

    Equal windows have one anchor at one offset, so they lie in different occurrences of it. Where all of an
    anchor's stretches occur again, or there is one only, its windows are decided by that; only the stretches of
    other anchors are fetched and sorted.
    """
    summed = kept.groupBy("h", "g").agg(F.least(F.count("*"), F.lit(2)).alias("m"), F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.min(F.struct("doc", "p")).alias("one"))
    again = F.when(F.col("one.p").bitwiseAND(OF_WORDS) != 0, F.col("lo") < F.col("hi")).otherwise(F.col("m") > 1)
    kinds = materialize(summed.withColumn("again", again))
    mixed = materialize(kinds.groupBy("h").agg(F.count("*").alias("kinds"), F.min("again").alias("all")).where("kinds > 1 and not all").select("h"))
    asked = kinds.join(mixed, "h").select(*SHARED, "one.*").groupBy("doc").agg(F.collect_list(F.struct(*SHARED, "p")).alias("asked"))
    asked = materialize(asked.join(names, "doc").select("k1", "k2", "asked"))
    del summed
    release(texts.sparkSession)
    packed = texts.select("data", "k1", "k2").mapInArrow(lambda it: _squeeze(it, 0), "data binary, k1 long, k2 long")
    fetched = packed.join(asked, ["k1", "k2"]).select("data", "asked").mapInArrow(_fetch, "h long, g long, m long, lo long, hi long, n long, data binary")
    sharded = fetched.repartition("h").sortWithinPartitions("h", "g")
    sorted_runs = sharded.mapInArrow(_sort_shards, "h long, g long, runs array<long>")
    decided = kinds.where("again").join(mixed, "h", "left_anti").select("h", "g", F.array(F.col("one.p").bitwiseAND(PLACE_LOW)).alias("runs"))
    return materialize(sorted_runs.unionByName(decided))


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of ranges that overlap or touch."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    first = np.r_[True, starts[1:] > reach[:-1]]
    return starts[first], reach[np.r_[np.flatnonzero(first)[1:] - 1, len(reach) - 1]]


def _apply(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    expand, with_text = zstandard.ZstdDecompressor(), "_sd_kept" in names
    for batch in batches:
        rows = []
        for data, ranges, passages in zip(*(batch.column(c) for c in ("_sd_data", "_sd_ranges", "_sd_passages")), strict=True):
            raw = expand.decompress(data.as_buffer())
            again = merged(passages.values.field("a").to_numpy(), passages.values.field("b").to_numpy()) if passages.is_valid and len(passages) else None
            words = (len(again[0]), int((again[1] - again[0]).sum())) if again else (0, 0)
            if not ranges.is_valid or not len(ranges):
                rows.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), *words, raw if with_text else b""))
                continue
            a, b = merged(ranges.values.field("a").to_numpy(), ranges.values.field("b").to_numpy())
            kept = b"".join(raw[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)], strict=True))
            rows.append((len(raw), len(raw) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), *words, kept if with_text else b""))
        made = dict(zip([*MADE, "_sd_kept"], zip(*rows, strict=True) if rows else [[]] * 7, strict=True))
        kinds = MADE | {"_sd_kept": pa.binary()}
        yield pa.RecordBatch.from_arrays([pa.array(made[n], kinds[n]) if n in made else batch.column(n) for n in names], names)


#: Columns that ``remove_repeats`` adds.
MADE = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "n_passages": pa.int64(), "passage_words": pa.int64()}


def remove_repeats(docs: DataFrame, text_col: str = "text", with_text: bool = True) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, if asked, the kept bytes ``_sd_kept``.

    ``n_passages`` and ``passage_words`` count the maximal runs of words that are covered by strings of
    ``PASSAGE`` words that another document has, and their words.
    """
    data = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumns({"_sd_data": data.cast("binary"), "_sd_k1": F.xxhash64(data), "_sd_k2": F.xxhash64(F.lit(7), data)})
    ranges = covered_ranges(rows.select(F.col("_sd_data").alias("data"), F.col("_sd_k1").alias("k1"), F.col("_sd_k2").alias("k2")))
    ranges = ranges.toDF("_sd_k1", "_sd_k2", "_sd_ranges", "_sd_passages")
    new = [*MADE] + ["_sd_kept"] * with_text
    old = [c for c in docs.columns if c not in new and (with_text or c != text_col)]
    schema = docs.select(*old).schema
    for name in new:
        schema = schema.add(name, "binary" if name == "_sd_kept" else "string" if name == "kept_sha256" else "long")
    rows = rows.select(*old, "_sd_data", "_sd_k1", "_sd_k2")
    packed = rows.mapInArrow(lambda it: _squeeze(it, len(old)), rows.schema)
    joined = packed.join(ranges, ["_sd_k1", "_sd_k2"], "left").select(*old, "_sd_data", "_sd_ranges", "_sd_passages")
    return joined.mapInArrow(lambda it: _apply(it, [*old, *new]), schema)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)


def _runs(places: str, reach: int, name: str) -> str:
    """Maximal runs, as ``(r, a, b)``, of windows of ``reach`` that start at ``places(r, i)``."""
    turn = f"coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + {reach}, TRUE)::INT"
    return f"{name} AS (SELECT r, min(i) AS a, max(i) + {reach} AS b FROM (SELECT r, i, sum(t) OVER (PARTITION BY r ORDER BY i) AS k FROM (SELECT r, i, {turn} AS t FROM {places})) GROUP BY r, k)"


#: Every window of every text, told apart by hash; for tables of a few million bytes.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT r, i, hash(array_slice(t, i + 1, i + {WINDOW})) AS h FROM (SELECT r, t, unnest(range(octet_length(t) - {WINDOW - 1})) AS i FROM d)),
again AS (SELECT r, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)), {_runs("again", WINDOW, "s")},
p AS (SELECT r, i, hash(array_to_string(ws[i + 1 : i + {PASSAGE}], ' ')) AS h FROM (SELECT r, ws, unnest(range(len(ws) - {PASSAGE - 1})) AS i FROM d)),
also AS (SELECT r, i FROM p WHERE h IN (SELECT h FROM p GROUP BY h HAVING min(r) < max(r))), {_runs("also", PASSAGE, "q")},
cut AS (SELECT r, count(*) AS n, sum(b - a)::BIGINT AS removed, max(b) AS stop, string_agg(hex(array_slice(t, before + 1, a)), '' ORDER BY a) AS head FROM (SELECT r, a, b, t, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM s JOIN d USING (r)) GROUP BY r),
told AS (SELECT r, count(*) AS n, sum(b - a)::BIGINT AS words FROM q GROUP BY r)
SELECT doc_id, octet_length(t)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(cut.n, 0)::BIGINT AS n_spans,
  sha256(CASE WHEN removed IS NULL THEN t ELSE unhex(head || hex(array_slice(t, stop + 1, octet_length(t)))) END) AS kept_sha256, coalesce(told.n, 0)::BIGINT AS n_passages, coalesce(words, 0)::BIGINT AS passage_words
FROM d LEFT JOIN cut USING (r) LEFT JOIN told USING (r)
"""
