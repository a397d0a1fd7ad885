"""Alignment of the tokens that two tokenizers make of a text, and what the corpus says about pairs of their ids.

Tokens of both sides are byte ranges of one text. Every token points to the token of the other side that overlaps it and reaches
farthest right; a token of the second side that ends where one of the first side ends points to itself. Doubling the
pointers until they stand still brings each token to the last one of its component, which labels its group. The tokens of
many texts are one array, so this is a few numpy operations on some megabytes of text.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weatherlake.llm import token_files
from weatherlake.llm.common import stored

# Bytes of text that are aligned at once, and links of them that are expanded at once.
CHUNK_BYTES = 2 << 20
LINKS_AT_ONCE = 2_000_000
# A pair with more than this fraction of all pair occurrences is frequent, so fewer than FREQUENT pairs are.
FREQUENT = 400_000
BLANK = "▁"


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if it prints, else from 256 on in turn."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """The bytes of each id, and their lengths."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.lengths = np.array([len(piece) for piece in pieces], np.int64)
        self.size = len(pieces)


class Aligner:
    """Encodes texts on both sides and aligns them: side A byte-level, side B of pieces that add a space in front."""

    def __init__(self, a_file: str, b_file: str):
        self.a = token_files.id_encoder(a_file, True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        alphabet = byte_alphabet()
        by_id = {i: piece for piece, i in Tokenizer.from_file(a_file).get_vocab().items()}
        self.a_ids = Vocabulary([
            bytes(map(alphabet.__getitem__, by_id[i])) if i in by_id and all(c in alphabet for c in by_id[i]) else b""
            for i in range(max(by_id) + 1)
        ])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_ids = Vocabulary([
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
            else b"" if self.b.is_control(i) or self.b.is_unknown(i)
            else piece.replace(BLANK, " ").encode()
            for i, piece in enumerate(pieces)
        ])
        if self.a_ids.size * self.b_ids.size > 2**31:
            raise ValueError("the ids of a pair must fit in 31 bits")
        # An id with the mark before it: the first of a group and the others, of A and of B.
        marks = [(";", self.a_ids), (",", self.a_ids), ("|", self.b_ids), (",", self.b_ids)]
        self.written = [f"{mark}{i}".encode() for mark, ids in marks for i in range(ids.size)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of A, number of them in each text, the same of B); a text whose bytes differ on a side has no ids."""
        wanted = [b" " + text.encode() if text else b"" for text in texts]
        a_found = self.a.encode([" " + text if text else "" for text in texts])
        b_found = self.b.encode(texts, num_threads=1)
        a_counts = np.array([len(ids) // 4 for ids in a_found], np.int64)
        b_counts = np.array([len(ids) for ids in b_found], np.int64)
        a = np.frombuffer(b"".join(a_found), "<u4").astype(np.int64)
        b = np.fromiter(chain.from_iterable(b_found), np.int64, int(b_counts.sum()))
        same = self._equal(self.a_ids, a, a_counts, wanted) & self._equal(self.b_ids, b, b_counts, wanted)
        a, b = a[np.repeat(same, a_counts)], b[np.repeat(same, b_counts)]
        return a, a_counts * same, b, b_counts * same

    @staticmethod
    def _equal(vocabulary: Vocabulary, ids: np.ndarray, counts: np.ndarray, wanted: list[bytes]) -> np.ndarray:
        joined = b"".join(map(vocabulary.pieces.__getitem__, ids.tolist()))
        ends = np.append(0, np.cumsum(vocabulary.lengths[ids]))[np.append(0, np.cumsum(counts))].tolist()
        return np.array([joined[start:stop] == text for start, stop, text in zip(ends[:-1], ends[1:], wanted)], bool)


@functools.lru_cache(maxsize=2)
def aligner(a_file: str, b_file: str) -> Aligner:
    return Aligner(a_file, b_file)


def group_labels(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, numbered from 0, from the ascending byte offsets where they end."""
    n_a = len(a_ends)
    over_a = np.searchsorted(b_ends, a_ends)  # the B token with the last byte of each A token
    over_b = np.searchsorted(a_ends, b_ends)
    last = a_ends[np.minimum(over_b, n_a - 1)] == b_ends if n_a else np.zeros(0, bool)
    itself = np.arange(n_a, n_a + len(b_ends))
    to = np.concatenate([n_a + over_a, np.where(last, itself, over_b)])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            break
        to = further
    number = np.cumsum(last) - 1
    labels = number[to - n_a]
    return labels[:n_a], labels[n_a:]


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its count."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def _distinct(text: np.ndarray, pair: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (text, pair) in ascending order, and how often each occurs."""
    keys = text.astype(np.uint64) << np.uint64(32) | pair.astype(np.uint64)
    if times is None:
        keys.sort()
    else:
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
    firsts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(firsts, len(keys))) if times is None else np.add.reduceat(times, firsts) if len(firsts) else times
    keys = keys[firsts]
    return (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), counts.astype(np.int64)


class Chunk:
    """The aligned tokens of some texts."""

    def __init__(self, own: Aligner, texts: list[str]):
        self.own = own
        self.a, self.n_a, self.b, self.n_b = own.encode(texts)
        self.a_group, self.b_group = group_labels(np.cumsum(own.a_ids.lengths[self.a]), np.cumsum(own.b_ids.lengths[self.b]))
        n_groups = int(self.a_group[-1]) + 1 if len(self.a) else 0
        self.a_in, self.b_in = np.bincount(self.a_group, minlength=n_groups), np.bincount(self.b_group, minlength=n_groups)
        self.a_end, self.b_end = np.cumsum(self.a_in), np.cumsum(self.b_in)
        self.a_start, self.b_start = self.a_end - self.a_in, self.b_end - self.b_in
        texts_of_a = np.repeat(np.arange(len(texts)), self.n_a)
        text_of_group = texts_of_a[self.a_start]
        self.n_groups = np.bincount(text_of_group, minlength=len(texts))
        self.n_links = np.zeros(len(texts), np.int64)
        np.add.at(self.n_links, text_of_group, self.a_in * self.b_in)

    def written(self) -> list[bytes]:
        """Each text's groups as a1,a2|b1;a3|b2,b3, empty without tokens."""
        a_first = np.zeros(len(self.a), bool)
        a_first[self.a_start] = True
        b_first = np.zeros(len(self.b), bool)
        b_first[self.b_start] = True
        a_size, b_size = self.own.a_ids.size, self.own.b_ids.size
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + self.b_start[self.a_group]] = np.where(a_first, self.a, self.a + a_size)
        codes[np.arange(len(self.b)) + self.a_end[self.b_group]] = 2 * a_size + np.where(b_first, self.b, self.b + b_size)
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        names = self.own.written
        return [b"".join(map(names.__getitem__, codes[start:stop].tolist()))[1:] for start, stop in zip([0, *ends], ends)]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(texts, pairs, links) for the different id pairs that each text links, some at a time.

        A part has whole texts, or the pairs of one text with some of its A ids, so no pair of a text is in two parts.
        """
        a_stops = np.cumsum(self.n_a)
        start = 0
        done = 0
        sums = np.cumsum(self.n_links)
        while start < len(sums):
            stop = max(start + 1, int(np.searchsorted(sums, done + LINKS_AT_ONCE, side="right")))
            done = int(sums[stop - 1])
            first, last = int(a_stops[start - 1]) if start else 0, int(a_stops[stop - 1])
            if stop == start + 1 and self.n_links[start] > LINKS_AT_ONCE:
                yield from self._pairs_of_one(start, first, last)
            elif last > first:
                group = self.a_group[first:last]
                counts = self.b_in[group]
                pair = np.repeat(self.a[first:last], counts) * self.own.b_ids.size + self.b[_ranges(self.b_start[group], counts)]
                text = np.repeat(np.repeat(np.arange(start, stop), self.n_a[start:stop]), counts)
                yield _distinct(text, pair)
            start = stop

    def _pairs_of_one(self, text: int, first: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The pairs of a text with many links: equal ids of a group are counted before they meet the other side's."""
        groups = slice(int(self.a_group[first]), int(self.a_group[last - 1]) + 1)
        low, high = int(self.b_start[groups.start]), int(self.b_end[groups.stop - 1])
        b_group, b, b_times = _distinct(self.b_group[low:high], self.b[low:high])
        a, a_group, a_times = _distinct(self.a[first:last], self.a_group[first:last])  # by id, then by group
        n_b = np.bincount(b_group - groups.start, minlength=groups.stop - groups.start)
        b_start = np.cumsum(n_b) - n_b
        counts = n_b[a_group - groups.start]
        # Parts end where the A id changes.
        ids = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        sums = np.append(0, np.cumsum(counts))
        while len(ids):
            stop = int(np.searchsorted(sums[np.append(ids[1:], len(a))], sums[ids[0]] + LINKS_AT_ONCE, side="right"))
            stop = max(stop, 1)
            part = slice(int(ids[0]), int(ids[stop]) if stop < len(ids) else len(a))
            ids = ids[stop:]
            at = _ranges(b_start[a_group[part] - groups.start], counts[part])
            pair = np.repeat(a[part], counts[part]) * self.own.b_ids.size + b[at]
            times = np.repeat(a_times[part], counts[part]) * b_times[at]
            yield _distinct(np.full(len(pair), text), pair, times)


FIELDS = [
    pa.field("row", pa.int64()), pa.field("doc_id", pa.int64()), pa.field("n_a", pa.int64()), pa.field("n_b", pa.int64()),
    pa.field("n_groups", pa.int64()), pa.field("n_links", pa.int64()), pa.field("groups_sha256", pa.string()),
    pa.field("pairs", pa.list_(pa.int32())), pa.field("times", pa.list_(pa.int32())),
]
TYPES = "row LONG, doc_id LONG, n_a LONG, n_b LONG, n_groups LONG, n_links LONG, groups_sha256 STRING, pairs ARRAY<INT>, times ARRAY<INT>"


def align(
    docs: DataFrame, a_file: str, b_file: str, id_column: str = "doc_id", text_column: str = "text", with_groups: bool = False
) -> DataFrame:
    """The alignment of each row: row (a number of its own), doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times.

    `pairs` are the different id pairs that the text links, as a * (size of B's vocabulary) + b, `times` how many links each has; a row
    whose pairs do not fit in one array goes on in further rows that have only `row`, `pairs` and `times`. `with_groups`
    adds the groups as text. Null and empty texts, and texts that a side does not give back byte by byte, have no tokens.
    Both files must be at the same path on all executors.
    """
    fields = FIELDS + ([pa.field("groups", pa.string())] if with_groups else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_file, b_file)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for some in token_files.chunks(batch, CHUNK_BYTES):
                texts = some.column(1).to_pylist()
                chunk = Chunk(own, texts)
                groups = chunk.written()
                digests = [hashlib.sha256(text).hexdigest() if text else "" for text in groups]
                seen = 0  # rows whose own columns are out
                for which, pairs, times in chain(chunk.pairs(), [(None, np.zeros(0, np.int64), np.zeros(0, np.int64))]):
                    upto = len(texts) if which is None else int(which[-1]) + 1
                    first = min(seen, upto if which is None else int(which[0]))
                    new = slice(first, upto)
                    again = upto <= seen and which is not None
                    if again or upto > first:
                        counts = np.zeros(upto - first, np.int64) if which is None else np.bincount(which - first, minlength=upto - first)
                        ends = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                        own_columns = [some.column(0).to_pylist(), chunk.n_a, chunk.n_b, chunk.n_groups, chunk.n_links, digests]
                        columns = [
                            np.arange(row + first, row + upto),
                            *[[None] * (upto - first) if again else list(column[new]) for column in own_columns],
                            pa.ListArray.from_arrays(ends, pa.array(pairs.astype(np.int32))),
                            pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
                        ]
                        if with_groups:
                            columns.append([None] * (upto - first) if again else [text.decode() for text in groups[new]])
                        arrays = [c if isinstance(c, pa.Array) else pa.array(c, field.type) for c, field in zip(columns, fields)]
                        yield pa.record_batch(arrays, schema=pa.schema(fields))
                    seen = max(seen, upto)
                row += len(texts)

    inputs = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text")
    )
    return inputs.mapInArrow(run, TYPES + (", groups STRING" if with_groups else ""))


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """pair, docs (rows that link it), best (no pair of its A id is linked in more rows)."""
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")), "pair-counts")
    a = F.floor(F.col("pair") / b_size).alias("a")
    # One row an A id, so never more than its vocabulary.
    most = counts.groupBy(a).agg(F.max("docs").alias("most"))
    return counts.withColumn("a", a).join(F.broadcast(most), "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, a_file: str, b_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `n_best` counts the links whose pair is linked in as many rows as any pair of the A id, `count_sum` adds the links' rows.
    Repeated rows count each; rows without tokens have zeros and an empty digest; an empty table gives an empty result;
    other columns are not read.

    Texts are encoded once. What the counts of frequent pairs give is looked up in the workers; the other pairs, each with a
    small share of all, are joined with their counts.
    """
    b_size = sentencepiece.SentencePieceProcessor(model_file=b_file).get_piece_size()
    aligned = stored(align(docs, a_file, b_file, id_column, text_column), "aligned")
    counts = stored(pair_counts(aligned, b_size), "pairs")
    total = counts.agg(F.sum("docs")).first()[0] or 0
    # Fewer than FREQUENT rows, whatever the data.
    frequent = counts.where(F.col("docs") * FREQUENT > total).orderBy("pair").toArrow()
    table = docs.sparkSession.sparkContext.broadcast(
        [frequent.column("pair").to_numpy(), frequent.column("docs").to_numpy(), frequent.column("best").to_numpy()]
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs_of, best_of = table.value
        for batch in batches:
            pairs, times = (batch.column(i) for i in (batch.num_columns - 2, batch.num_columns - 1))
            lengths = np.diff(np.array(pairs.offsets, np.int64))
            pair = pairs.flatten().to_numpy()
            links = times.flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(lengths)), lengths)
            at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            found = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            sums, best = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            hit = at[found]
            np.add.at(sums, row[found], links[found] * docs_of[hit])
            np.add.at(best, row[found], links[found] * best_of[hit])
            ends = pa.array(np.append(0, np.cumsum(np.bincount(row[~found], minlength=len(lengths)))).astype(np.int32))
            own = [batch.column(i) for i in range(batch.num_columns - 2)]
            names = [field.name for field in FIELDS[:-2]]
            rest = [pa.ListArray.from_arrays(ends, pa.array(values)) for values in (pair[~found], links[~found].astype(np.int32))]
            yield pa.record_batch([*own, *rest, pa.array(best), pa.array(sums)], names=[*names, "pairs", "times", "n_best", "count_sum"])

    partly = stored(aligned.mapInArrow(look_up, TYPES + ", n_best LONG, count_sum LONG"), "partly")
    rest = partly.where(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    rest = rest.select("row", F.col("link.pairs").alias("pair"), F.col("link.times").cast("long").alias("times")).join(counts, "pair")
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum")
    )
    own = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    parts = partly.select("row", *own, "n_best", "count_sum").unionByName(rest, allowMissingColumns=True)
    return parts.groupBy("row").agg(
        *[F.max(name).alias(name) for name in own], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    ).drop("row")
