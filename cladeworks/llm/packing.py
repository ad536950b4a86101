"""Packing documents into fixed-length sequences along a Hilbert curve.

A document's token ids are hashed into a vector and projected to four coordinates; the Hilbert index of
the quantised coordinates orders the corpus, so neighbours on the curve are alike. The ids are laid
end to end in that order and cut every ``length`` ids, so only the last sequence is padded. Key ranges
with about equal numbers of ids are sorted and cut in parallel; a range starts where the ids of the
ranges before it end. Only range boundaries and sums, at most ``MAX_RANGES`` of them, come to the driver.

Defined results: null and empty texts give the closing id alone; equal keys are ordered by a hash of the
id, then the id, then the content, so repeated rows lie side by side; a null doc_id sorts first; a text
of any length is encoded whole; an empty table gives no pieces; only id and text are read, so other columns
cannot clash.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.runtime import materialize, read_table

LENGTH = 2048
CLOSING_ID = 1
VOCABULARY = "word_bpe_49k.json"
#: Hashed vector size, coordinates, bits a coordinate; the low bits of the order key come from the doc id.
BUCKETS, DIMS, BITS, SALT_BITS = 256, 4, 10, 22
#: Ids in a range of the order key, on average, and the most ranges.
RANGE_IDS, MAX_RANGES = 2_000_000, 20_000
BOUND_IDS = 512
#: Bytes of text encoded at once, unless one text has more.
BATCH_BYTES = 2_000_000
#: New words given to the tokenizer at once; its results are large.
LEARNED = 4096
#: Words whose ids a worker keeps at once.
CACHED_WORDS = 1_000_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Bytes of words hashed at once.
HASH_BYTES = 1 << 19
#: An odd number whose powers weigh the bytes of a word, and two random values for each byte.
HASH_BASE = 0x9E3779B97F4A7C15
BYTE_VALUES = np.random.default_rng(64).integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    up, down = (np.full(n, x, dtype=np.uint64) for x in (HASH_BASE, pow(HASH_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_marks(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each word (binary, without nulls), as differences of prefix sums over the bytes."""
    n = len(words)
    bounds = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + n + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)
    out = np.zeros((2, n), dtype=np.uint64)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + HASH_BYTES, side="right")) - 1)
        piece = data[bounds[at] : bounds[end]]
        starts, stops = bounds[at:end] - bounds[at], bounds[at + 1 : end + 1] - bounds[at]
        up, down = _powers(HASH_BYTES + 1) if len(piece) <= HASH_BYTES else _powers.__wrapped__(len(piece) + 1)
        for k in (0, 1):
            sums = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum(BYTE_VALUES[k][piece] * up[: len(piece)], out=sums[1:])
            out[k, at:end] = (sums[stops] - sums[starts]) * down[starts]
        at = end
    return out[0], out[1]


class WordEncoder:
    """Encodes texts word by word with a bounded memory of words; no token of the vocabulary spans white space.

    A-Z is lowered first, which the vocabulary's own normaliser does anyway. Closing punctuation is a
    piece of its own to it, so a word's stem and its closing punctuation are looked up apart. Words are
    remembered by two 64-bit hashes, sorted by the first; two words with one first hash are not both kept.
    """

    CLOSING = b".,;:!?&$#%*|"

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.cached_words = cached_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        # Of words of lower-case letters in normal form the vocabulary's normaliser and pattern change nothing.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # A text with the literal of a special token could match across what looks like words.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        """Start anew, with the empty word, which has no ids."""
        self.marks, self.others = (np.zeros(1, dtype=np.uint64) for _ in range(2))
        self.first, self.size = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.pool, self.used = np.zeros(1 << 16, dtype="<u2"), 0

    def _store(self, ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of each word's ids in the pool."""
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 2
        more = np.frombuffer(b"".join(ids), dtype="<u2")
        if self.used + len(more) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(len(self.pool), 2 * len(more)), dtype="<u2")])
        self.pool[self.used : self.used + len(more)] = more
        first = self.used + np.cumsum(size) - size
        self.used += len(more)
        return first, size

    def _tokens(self, words: list[bytes]) -> list[bytes]:
        """Ids of words met for the first time."""
        texts = [w.decode("utf-8", "surrogatepass") for w in words]
        plain = [t.isalpha() and t == t.lower() and is_normalized("NFC", t) for t in texts]
        out: list[bytes] = [b""] * len(words)
        run = [i for i, p in enumerate(plain) if p]
        ids = np.array(self.plain.encode_batch_fast([" ".join([texts[i] for i in run])], add_special_tokens=False)[0].ids, dtype="<u2")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(run):
            data, at = ids.tobytes(), 0
            for i, stop in zip(run, (2 * stops).tolist(), strict=True):
                out[i], at = data[at:stop], stop
        else:  # white space by another reading
            plain = [False] * len(words)
        rest = [i for i, p in enumerate(plain) if not p]
        for encoding, i in zip(self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), rest, strict=True):
            out[i] = np.array(encoding.ids, dtype="<u2").tobytes()
        return out

    def _stem(self, word: bytes) -> bytes:
        """The word without closing punctuation, if what is left ends in a letter or digit."""
        stem = word.rstrip(self.CLOSING)
        last = stem[-1:]
        return stem if last.isalnum() or last > b"\x7f" and stem.decode("utf-8", "replace")[-1].isalpha() else word

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        closing = self.CLOSING
        stems = {i: s for i, w in enumerate(words) if w[-1] in closing for s in (self._stem(w),) if len(s) < len(w)}
        out: list[bytes] = [b""] * len(words)
        if stems:
            parts = list({x for i, s in stems.items() for x in (s, words[i][len(s) :])})
            first, size = self._places(pa.array(parts, pa.binary()))
            ids = dict(zip(parts, (self.pool[a : a + n].tobytes() for a, n in zip(first.tolist(), size.tolist(), strict=True)), strict=True))
            for i, s in stems.items():
                out[i] = ids[s] + ids[words[i][len(s) :]]
        rest = [i for i in range(len(words)) if i not in stems]
        for k in range(0, len(rest), LEARNED):
            some = rest[k : k + LEARNED]
            for i, found in zip(some, self._tokens([words[i] for i in some]), strict=True):
                out[i] = found
        return self._store(out)

    def _places(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of ids in the pool of distinct words; those met for the first time are learned together."""
        marks, others = word_marks(words)
        order = np.argsort(marks)
        at = np.minimum(np.searchsorted(self.marks, marks[order]), len(self.marks) - 1)
        seen = (self.marks[at] == marks[order]) & (self.others[at] == others[order])
        first, size = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        first[order[seen]], size[order[seen]] = self.first[at[seen]], self.size[at[seen]]
        new = order[~seen]
        if len(new):
            first[new], size[new] = self._learn(words.take(pa.array(new)).to_pylist())
            fresh = marks[new]
            at = np.searchsorted(self.marks, fresh)
            alone = np.r_[True, fresh[1:] != fresh[:-1]] & (self.marks[np.minimum(at, len(self.marks) - 1)] != fresh)
            at, new = at[alone], new[alone]
            self.marks, self.others = np.insert(self.marks, at, marks[new]), np.insert(self.others, at, others[new])
            self.first, self.size = np.insert(self.first, at, first[new]), np.insert(self.size, at, size[new])
        return first, size

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (strings without nulls) as 16-bit integers.

        A batch's words are told apart by Arrow, so the memory of words is asked once for each distinct one, and
        their ids are gathered for all places at once.
        """
        whole = np.zeros(len(texts), dtype=bool)
        for literal in self.special:
            whole |= pc.match_substring(texts, literal).to_numpy(zero_copy_only=False)
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(pa.array(whole), "", texts)))
        coded = lists.flatten().dictionary_encode()
        if len(self.marks) > self.cached_words:
            self._forget()
        first, size = self._places(coded.dictionary.cast(pa.binary()))
        at = coded.indices.to_numpy()
        counts = size[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total)
        place += np.repeat(first[at] - (ends - counts), counts)
        stream = self.pool[place]
        bounds = np.r_[0, ends][lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        out = [stream[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for i in np.flatnonzero(whole).tolist():
            out[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, dtype="<u2")
        return out


@cache
def _encoder(path: str, cached_words: int) -> WordEncoder:
    return WordEncoder(path, cached_words)


@cache
def _buckets() -> np.ndarray:
    """The hashed place of each id in a document's vector."""
    return (np.arange(1 << 16, dtype=np.uint32) * np.uint32(40503) >> np.uint32(4)) % np.uint32(BUCKETS)


@cache
def _projection() -> np.ndarray:
    return np.random.default_rng(20).standard_normal((BUCKETS, DIMS)).astype(np.float32)


def hilbert_index(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of integer points (rows), all rows at once; after Skilling (2004)."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            swap = (x[0] ^ x[i]) & low
            inside = (x[i] & q) != 0
            x[0] ^= np.where(inside, low, swap)
            if i:
                x[i] ^= np.where(inside, 0, swap)
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def curve_cells(ids: list[np.ndarray]) -> np.ndarray:
    """Quantised projections of hashed id vectors."""
    vectors = np.stack([np.bincount(_buckets()[i], minlength=BUCKETS) for i in ids]).astype(np.float32)
    vectors = np.log1p(vectors)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return np.clip((vectors @ _projection() + 3.0) * ((1 << BITS) / 6.0), 0, (1 << BITS) - 1).astype(np.int64)


def _encode(batches: Iterator[pa.RecordBatch], path: str, cached_words: int) -> Iterator[pa.RecordBatch]:
    import zstandard

    squeeze, encoder = zstandard.ZstdCompressor(level=1), _encoder(path, cached_words)
    for whole in batches:
        column = whole.column(1)
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy()
        at = 0
        while at < len(sizes):
            end, size = at + 1, sizes[at]
            while end < len(sizes) and size + sizes[end] < BATCH_BYTES:
                size += sizes[end]
                end += 1
            ids = [np.append(x, np.uint16(CLOSING_ID)) for x in encoder.encode(column.slice(at, end - at).fill_null(""))]
            batch = whole.slice(at, end - at)
            key = hilbert_index(curve_cells(ids)) << SALT_BITS | (batch.column(2).to_numpy(zero_copy_only=False) & ((1 << SALT_BITS) - 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key), pa.array([len(i) for i in ids], pa.int64()), pa.array([squeeze.compress(x.tobytes()) for x in ids], pa.binary())], ["_pk_id", "_pk_key", "_pk_n", "_pk_ids"])
            at = end


def _ranges(batches: Iterator[pa.RecordBatch], bounds: list[int]) -> Iterator[pa.RecordBatch]:
    edges = np.array(bounds, dtype=np.int64)
    for batch in batches:
        where = np.searchsorted(edges, batch.column("_pk_key").to_numpy(), side="right").astype(np.int32)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(where)], [*batch.schema.names, "_pk_range"])


def _cut(batches: Iterator[pa.RecordBatch], starts: dict[int, int], length: int, closing: bool) -> Iterator[pa.RecordBatch]:
    import zstandard

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if closing else [])]
    expand, position, current = zstandard.ZstdDecompressor(), 0, None
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for doc, n, packed, where in zip(*(batch.column(c).to_pylist() for c in ("_pk_id", "_pk_n", "_pk_ids", "_pk_range")), strict=True):
            if where != current:
                current, position = where, starts[where]
            ids = np.frombuffer(expand.decompress(packed, max_output_size=2 * n), dtype="<u2")
            at = 0
            while at < n:
                take = min(n - at, length - position % length)
                piece = ids[at : at + take].astype("<u4")
                row = [doc, at, take, zlib.crc32(piece.tobytes()), n, position // length, position % length, *([piece.tolist()] if closing else [])]
                for column, value in zip(out, row, strict=True):
                    column.append(value)
                at += take
                position += take
        kinds = [pa.int64()] * 7 + [pa.list_(pa.int64())] * closing
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, path: str | None = None, with_ids: bool = False, cached_words: int = CACHED_WORDS) -> DataFrame:
    """One row a piece; ``with_ids`` adds the ids themselves. Fewer ``cached_words`` cost time and save memory of the workers."""
    path = path or vocabulary_path()
    rows = docs.select(F.col(id_col).cast("long").alias("_pk_id"), F.col(text_col).alias("_pk_text"), F.xxhash64(F.col(id_col).cast("long")).alias("_pk_salt"))
    coded = materialize(rows.mapInArrow(lambda it: _encode(it, path, cached_words), "_pk_id long, _pk_key long, _pk_n long, _pk_ids binary"))
    total = coded.agg(F.coalesce(F.sum("_pk_n"), F.lit(0))).first()[0]
    parts = min(MAX_RANGES, max(1, -(-total // RANGE_IDS)))
    bounds = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        # A document counts once for each BOUND_IDS ids, so ranges have about equal numbers of ids.
        weighed = coded.select(F.explode(F.array_repeat("_pk_key", F.ceil(F.col("_pk_n") / BOUND_IDS).cast("int"))).alias("_pk_key"))
        bounds = sorted(set(weighed.agg(F.percentile_approx("_pk_key", shares, max(10_000, 20 * parts))).first()[0]))
    ranged = coded.mapInArrow(lambda it: _ranges(it, bounds), "_pk_id long, _pk_key long, _pk_n long, _pk_ids binary, _pk_range int")
    sums = dict(coded.select("_pk_key", "_pk_n").mapInArrow(lambda it: _ranges(it, bounds), "_pk_key long, _pk_n long, _pk_range int").groupBy("_pk_range").agg(F.sum("_pk_n")).collect())
    starts, at = {}, 0
    for part in sorted(sums):
        starts[part], at = at, at + sums[part]
    ordered = ranged.repartitionById(len(bounds) + 1, F.col("_pk_range")).sortWithinPartitions("_pk_range", "_pk_key", "_pk_id", "_pk_ids")
    fields = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<long>" * with_ids
    return ordered.mapInArrow(lambda it: _cut(it, starts, length, with_ids), fields)


def op5_hilbert_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
