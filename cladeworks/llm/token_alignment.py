"""Alignment of two tokenizers' tokens by byte offset, with the strength of every linked pair of ids over the corpus.

The documents of an Arrow batch are laid end to end, each from its own byte offset. The ends of all A tokens and of
all B tokens are counted by byte with one ``bincount`` each; where both end, the batch is cut into groups, and where either
ends, one A token and one B token overlap, which is a link. Prefix sums over these marks, taken at the documents' offsets, give each
document's groups and links, so nothing loops over documents or tokens.

Texts are encoded once and their ids written to the shared folder. A first pass over them counts linked pairs, summed
in each worker and then by pair; a second looks up each link's count and whether no other A id is linked
to its B id more often. Pairs are looked up in a sorted array that is sent to the workers and holds the most frequent ones,
``SENT_PAIRS`` at most; the links of all other pairs are joined with the table of pairs, so every link is resolved
whatever the size of the corpus.

Defined results: null and empty texts, and texts whose joined A or B bytes are not a space and the text, have no tokens and
zeros throughout; repeated rows, and repeated or null ids, count as often as they are there; ties for the highest count all
count as best; a text of any length is encoded whole and is a piece of its own if it is longer than ``PIECE_BYTES``; strings of
special tokens are plain text; an empty table gives no rows. Only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeworks.runtime import ensure_checkpoint_dir, materialize, read_table

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text laid end to end at once, unless one text has more.
PIECE_BYTES = 1 << 20
#: Pairs sent to every worker; 17 bytes each.
SENT_PAIRS = 1_000_000
#: Distinct pairs that a worker sums before it hands them on.
SUMMED_PAIRS = 2_000_000
#: The pattern of the fast encoder overflows its stack on much longer white space.
LONG_SPACE = 20_000
SPACE = re.compile(r"\s+")


class Tokens(NamedTuple):
    """A vocabulary: how a text is encoded, the bytes that a list of ids stands for, and those of each id."""

    encode: Callable[[str], list[int]]
    joined: Callable[[list[int]], bytes]
    pieces: list[bytes]


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_level_alphabet() -> dict[str, int]:
    """The character that stands for each byte: itself if printable, else one from 256 on, in order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@cache
def byte_tokens(name: str = BYTE_VOCABULARY) -> Tokens:
    """Byte-level BPE of a space and the text. Where ids are ranks of merges, a rank encoder gives the same ids in a third of the time."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    slow = Tokenizer.from_file(_path(name))
    slow.encode_special_tokens = True
    alphabet = byte_level_alphabet()
    special = {t.content for t in slow.get_added_tokens_decoder().values()}
    ranks = {bytes(alphabet[c] for c in token): i for token, i in slow.get_vocab().items() if token not in special}
    pieces = [b""] * slow.get_vocab_size()
    for piece, i in ranks.items():
        pieces[i] = piece
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        text = " " + text
        return slow.encode(text, add_special_tokens=False).ids if _spaced_out(text) else fast.encode_ordinary(text)

    return Tokens(encode, fast.decode_bytes, pieces)


@cache
def piece_tokens(name: str = PIECE_VOCABULARY) -> Tokens:
    """Sentence pieces with byte fallback; the model puts the space before the text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=_path(name))
    size = model.get_piece_size()
    pieces = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in range(size)]
    return Tokens(model.encode, lambda ids: b"".join(map(pieces.__getitem__, ids)), pieces)


def _spaced_out(text: str) -> bool:
    return len(text) > LONG_SPACE and any(m.end() - m.start() > LONG_SPACE for m in SPACE.finditer(text))


def id_type(tokens: Tokens) -> np.dtype:
    return np.dtype(np.min_scalar_type(len(tokens.pieces) - 1)).newbyteorder("<")


def _cuts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``PIECE_BYTES``."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + PIECE_BYTES, side="right")))
        yield at, end
        at = end


def encoded(docs: DataFrame, id_col: str, text_col: str, a_name: str, b_name: str) -> DataFrame:
    """``row``, ``doc_id`` and the ids of both tokenizers as little-endian bytes, both empty where the texts have no tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = byte_tokens(a_name), piece_tokens(b_name)
        types = [id_type(s) for s in sides]
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
            for at, end in _cuts(sizes):
                part = batch.slice(at, end - at)
                columns: list[list[bytes]] = [[b""] * part.num_rows, [b""] * part.num_rows]
                for i, text in enumerate(part.column(2).to_pylist()):
                    if text:
                        whole, ids = b" " + text.encode(), [side.encode(text) for side in sides]
                        if all(side.joined(x) == whole for side, x in zip(sides, ids, strict=True)):
                            for column, x, kind in zip(columns, ids, types, strict=True):
                                column[i] = np.array(x, dtype=kind).tobytes()
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c, pa.binary()) for c in columns)], ["row", "doc_id", "a", "b"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "row long, doc_id long, a binary, b binary")


class Aligned(NamedTuple):
    """Tokens, groups and links of documents laid end to end; bounds have an entry more than there are documents."""

    a: np.ndarray
    b: np.ndarray
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    group_bounds: np.ndarray
    link_bounds: np.ndarray
    #: A and B tokens before each group's end, and the two tokens of each link.
    a_ends: np.ndarray
    b_ends: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(a: np.ndarray, b: np.ndarray, a_counts: np.ndarray, b_counts: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> Aligned:
    """``a`` and ``b``: ids of all documents; counts: ids by document; sizes: bytes by id. Both sides have the same bytes."""
    a_bounds, b_bounds = (np.concatenate([[0], np.cumsum(c)]) for c in (a_counts, b_counts))
    a_stops, b_stops = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])
    total = int(a_stops[-1]) if len(a_stops) else 0
    at_a, at_b = np.bincount(a_stops, minlength=total + 1), np.bincount(b_stops, minlength=total + 1)
    both, either = (at_a & at_b) > 0, (at_a | at_b) > 0
    offsets = np.concatenate([[0], a_stops])[a_bounds]
    a_before, b_before = np.cumsum(at_a), np.cumsum(at_b)
    cut, link = np.flatnonzero(both), np.flatnonzero(either)
    return Aligned(
        a, b, a_bounds, b_bounds, np.cumsum(both)[offsets] if total else np.zeros_like(a_bounds), np.cumsum(either)[offsets] if total else np.zeros_like(a_bounds),
        a_before[cut], b_before[cut], a_before[link] - at_a[link], b_before[link] - at_b[link],
    )


def group_texts(x: Aligned, decimals: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All documents' ``a1,a2|b1;a3|b2,b3`` as bytes, and their bounds. ``decimals``: digits of each number, left-justified, and how many."""
    digits, widths = decimals
    n, groups = len(x.a) + len(x.b), len(x.a_ends)
    a_in, b_in = np.diff(x.a_ends, prepend=0), np.diff(x.b_ends, prepend=0)
    ids = np.empty(n, dtype=np.int64)
    # An A token comes after the B tokens of earlier groups, a B token after the A tokens of its own too.
    ids[np.arange(len(x.a)) + np.repeat(x.b_ends - b_in, a_in)] = x.a
    ids[np.arange(len(x.b)) + np.repeat(x.a_ends, b_in)] = x.b
    after = np.full(n, ord(","), dtype=np.uint8)
    after[x.a_ends + x.b_ends - b_in - 1] = ord("|")
    after[x.a_ends + x.b_ends - 1] = ord(";")
    last = x.group_bounds[1:][np.diff(x.group_bounds) > 0] - 1
    used = widths[ids] + 1
    used[(x.a_ends + x.b_ends - 1)[last]] -= 1
    cells = digits[ids]
    cells[np.arange(n), widths[ids]] = after
    bounds = np.concatenate([[0], np.cumsum(used)])[x.a_bounds + x.b_bounds]
    return cells[np.arange(cells.shape[1]) < used[:, None]] if groups else np.zeros(0, np.uint8), bounds


def decimals_below(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 to n - 1, left-justified with a place for one more character, and how many there are."""
    text = np.arange(n).astype("S")
    width = text.dtype.itemsize
    digits = np.zeros((n, width + 1), dtype=np.uint8)
    digits[:, :width] = text.view(np.uint8).reshape(n, width)
    return digits, np.char.str_len(text)


def _flat(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of id bytes, and how many each row has."""
    counts = pc.binary_length(column).to_numpy(zero_copy_only=False) // kind.itemsize
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype=kind).astype(np.int64), counts


def _pieces(batches: Iterator[pa.RecordBatch], a_name: str, b_name: str) -> Iterator[tuple[pa.RecordBatch, Aligned, np.ndarray]]:
    """Slices of batches, their alignment, and each link's pair of ids as one number."""
    sides = byte_tokens(a_name), piece_tokens(b_name)
    (a_type, a_sizes), (b_type, b_sizes) = ((id_type(s), np.array([len(p) for p in s.pieces])) for s in sides)
    for batch in batches:
        for at, end in _cuts(pc.binary_length(batch.column("a")).to_numpy(zero_copy_only=False)):
            part = batch.slice(at, end - at)
            (a, a_counts), (b, b_counts) = _flat(part.column("a"), a_type), _flat(part.column("b"), b_type)
            x = align(a, b, a_counts, b_counts, a_sizes, b_sizes)
            yield part, x, a[x.link_a] * len(b_sizes) + b[x.link_b]


def pair_counts(ids: DataFrame, a_name: str, b_name: str) -> DataFrame:
    """``pair``, ``n`` (its links) and ``best`` (1 if no A id has more links with the B id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for _, _, links in _pieces(batches, a_name, b_name):
            new, n = np.unique(links, return_counts=True)
            both = np.concatenate([pairs, new])
            order = np.argsort(both, kind="stable")
            both, weights = both[order], np.concatenate([counts, n])[order]
            first = np.flatnonzero(np.diff(both, prepend=-1))
            pairs, counts = both[first], np.add.reduceat(weights, first) if len(first) else weights
            if len(pairs) > SUMMED_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])
                pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])

    counted = ids.select("a", "b").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # A B id has no more pairs than A has ids.
    most = F.max("n").over(Window.partitionBy(F.col("pair") % len(piece_tokens(b_name).pieces)))
    return counted.withColumn("best", (F.col("n") == most).cast("int"))


def _least_sent(pairs: DataFrame, bound: int) -> int:
    """The least power of two such that no more than ``bound`` pairs have as many links."""
    levels = pairs.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).count().orderBy(F.desc("level")).collect()
    held, least = 0, 62
    for row in levels:
        held += row["count"]
        if held > bound:
            break
        least = row["level"]
    return 1 << least


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_name: str = BYTE_VOCABULARY, b_name: str = PIECE_VOCABULARY, sent_pairs: int = SENT_PAIRS, groups: bool = False) -> DataFrame:
    """A row for each document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``; ``groups`` adds the groups as text."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/alignment-{uuid.uuid4().hex}"
    encoded(docs, id_col, text_col, a_name, b_name).write.option("compression", "zstd").parquet(folder)
    ids = spark.read.parquet(folder)
    pairs = materialize(pair_counts(ids, a_name, b_name))
    least = _least_sent(pairs, sent_pairs)
    table = pairs.where(F.col("n") >= least).toArrow()
    order = np.argsort(table["pair"].to_numpy())
    sent = spark.sparkContext.broadcast(tuple(table[c].to_numpy()[order] for c in ("pair", "n", "best")))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = "row long, doc_id long, " + ", ".join(f"{c} long" for c in numbers) + ", groups_sha256 string, rest array<long>" + (", groups string" if groups else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = sent.value
        decimals = decimals_below(max(len(byte_tokens(a_name).pieces), len(piece_tokens(b_name).pieces)))
        for part, x, links in _pieces(batches, a_name, b_name):
            place = np.minimum(np.searchsorted(known, links), max(len(known) - 1, 0))
            found = known[place] == links if len(known) else np.zeros(len(links), dtype=bool)
            value, top = (np.where(found, c[place], 0) if len(known) else np.zeros(len(links), np.int64) for c in (counts, best))
            sums = [np.diff(np.concatenate([[0], np.cumsum(v, dtype=np.int64)])[x.link_bounds]) for v in (top, value)]
            others = np.concatenate([[0], np.cumsum(~found)])[x.link_bounds]
            text, bounds = group_texts(x, decimals)
            view = memoryview(text)
            spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
            digests = [hashlib.sha256(view[p:q]).hexdigest() if q > p else "" for p, q in spans]
            per_doc = [np.diff(b) for b in (x.a_bounds, x.b_bounds, x.group_bounds, x.link_bounds)]
            columns = [part.column("row"), part.column("doc_id"), *(pa.array(c, pa.int64()) for c in (*per_doc, *sums)), pa.array(digests), pa.ListArray.from_arrays(pa.array(others, pa.int32()), pa.array(links[~found]))]
            if groups:
                columns.append(pa.array([bytes(view[p:q]).decode() for p, q in spans], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", *numbers, "groups_sha256", "rest", *(["groups"] if groups else [])])

    rows = ids.mapInArrow(run, schema)
    if not pairs.where(F.col("n") < least).isEmpty():
        rows = materialize(rows)
        rest = rows.select("row", F.explode("rest").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("times"))
        rest = rest.join(pairs.where(F.col("n") < least), "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
        rows = rows.join(rest, "row", "left").withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return rows.select("doc_id", *numbers, "groups_sha256", *(["groups"] if groups else []))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(read_table(spark, sf_dir, "documents"))
