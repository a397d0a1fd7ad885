"""Token ids in binary files of patched frame-of-reference blocks.

A shard file holds the ids of its documents one after another, in blocks of BLOCK ids. A block stores its smallest id, the
other ids as distances from it in a fixed number of bits, wide enough for a given share of the distances, and the
distances that need more as an exception list of positions and high bits.

Layout, little-endian: the blocks; the block index (for each block its start in the file); the document index (for each
document its id, whether the id is there, and its number of ids); a footer with the counts. A block is a header
(smallest id, exceptions, width, ids) followed by the packed distances and the exceptions.
"""

from __future__ import annotations

import functools
import os
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weatherlake.llm import files
from weatherlake.llm.common import stored
from weatherlake.session import scratch_path

LANES, ROWS = 64, 64
BLOCK = LANES * ROWS
SHARE = 0.95
END_ID = 0
HEADER = struct.Struct("<IHBxI")
FOOTER = struct.Struct("<QQQ8s")
MAGIC = b"PFORIDS1"
BLOCKS_AT_ONCE = 256
# Frequent segments that a worker remembers, and the longest that it does.
REMEMBERED = 1_000_000
# Bytes of text that are encoded at once.
CHUNK_BYTES = 6 << 20
LONGEST_REMEMBERED = 64


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, BLOCK) numbers below 2 ** width as (blocks, width * LANES) words of 64 bits.

    Number r * LANES + lane lies at bit r * width of its lane, so that all lanes are packed with the same shifts.
    """
    rows = values.reshape(-1, ROWS, LANES).astype(np.uint64)
    out = np.zeros((len(rows), width, LANES), np.uint64)
    for r in range(ROWS):
        word, bit = divmod(r * width, 64)
        out[:, word] |= rows[:, r] << np.uint64(bit)
        if bit + width > 64:
            out[:, word + 1] |= rows[:, r] >> np.uint64(64 - bit)
    return out.reshape(len(rows), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    lanes = words.reshape(-1, width, LANES)
    out = np.zeros((len(lanes), ROWS, LANES), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for r in range(ROWS):
        word, bit = divmod(r * width, 64)
        out[:, r] = lanes[:, word] >> np.uint64(bit)
        if bit + width > 64:
            out[:, r] |= lanes[:, word + 1] << np.uint64(64 - bit)
    return (out & mask).reshape(len(lanes), BLOCK)


def encode_blocks(ids: np.ndarray, share: float = SHARE) -> list[bytes]:
    """Ids (unsigned 32-bit, any number) as blocks; the last may be short."""
    if not len(ids):
        return []
    n_blocks = -(-len(ids) // BLOCK)
    lengths = np.full(n_blocks, BLOCK)
    lengths[-1] = len(ids) - BLOCK * (n_blocks - 1)
    padded = np.empty(n_blocks * BLOCK, np.uint32)
    padded[: len(ids)] = ids
    padded[len(ids) :] = ids[-1]
    blocks = padded.reshape(n_blocks, BLOCK)
    least = blocks.min(axis=1)
    distances = blocks - least[:, None]
    usual = np.partition(distances, int(share * (BLOCK - 1)), axis=1)[:, int(share * (BLOCK - 1))]
    widths = np.frexp(usual.astype(np.float64))[1]  # bits of the number, 0 for 0
    out: list[bytes] = [b""] * n_blocks
    for width in np.unique(widths):
        which = np.flatnonzero(widths == width)
        low = distances[which] & np.uint32((1 << int(width)) - 1)
        packed = _pack(low, int(width)) if width else np.zeros((len(which), 0), np.uint64)
        for b, words in zip(which, packed):
            high = distances[b] >> np.uint32(width) if width < 32 else np.zeros(BLOCK, np.uint32)
            at = np.flatnonzero(high[: lengths[b]])
            out[b] = b"".join((
                HEADER.pack(int(least[b]), len(at), int(width), int(lengths[b])),
                words.tobytes(),
                at.astype("<u2").tobytes(),
                high[at].astype("<u4").tobytes(),
            ))
    return out


def decode_blocks(blocks: list[bytes]) -> np.ndarray:
    """The ids of consecutive blocks."""
    heads = [HEADER.unpack_from(block) for block in blocks]
    out = np.zeros((len(blocks), BLOCK), np.uint32)
    widths = np.array([head[2] for head in heads])
    for width in np.unique(widths):
        which = np.flatnonzero(widths == width)
        size = int(width) * LANES * 8
        words = b"".join(blocks[b][HEADER.size : HEADER.size + size] for b in which)
        if width:
            out[which] = _unpack(np.frombuffer(words, "<u8").reshape(len(which), -1), int(width))
    parts = []
    for b, (least, n, width, length) in enumerate(heads):
        start = HEADER.size + width * LANES * 8
        at = np.frombuffer(blocks[b], "<u2", n, start)
        out[b, at] |= np.frombuffer(blocks[b], "<u4", n, start + 2 * n) << np.uint32(width)
        parts.append(out[b, :length] + np.uint32(least))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


class ShardWriter:
    """Writes a shard block by block; what it holds is a few blocks and the two indexes."""

    def __init__(self, stream):
        self.stream, self.waiting, self.held = stream, [], 0
        self.starts: list[int] = []
        self.at = 0
        self.keys: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, key: int | None, ids: bytes) -> None:
        """A document's ids as little-endian unsigned 32-bit integers."""
        self.keys.append(key)
        self.lengths.append(len(ids) // 4)
        self.waiting.append(ids)
        self.held += len(ids) // 4
        if self.held >= BLOCKS_AT_ONCE * BLOCK:
            self._flush(self.held // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        for block in encode_blocks(ids[:n]):
            self.starts.append(self.at)
            self.stream.write(block)
            self.at += len(block)
        self.waiting, self.held = [ids[n:].tobytes()], len(ids) - n

    def close(self) -> None:
        self._flush(self.held)
        known = np.array([key is not None for key in self.keys], "u1")
        self.stream.write(np.array([*self.starts, self.at], "<u8").tobytes())
        self.stream.write(np.array([key or 0 for key in self.keys], "<i8").tobytes())
        self.stream.write(known.tobytes())
        self.stream.write(np.array(self.lengths, "<u8").tobytes())
        self.stream.write(FOOTER.pack(len(self.starts), len(self.keys), self.at, MAGIC))
        self.stream.close()


class ShardReader:
    """Reads documents of a shard; only the blocks that hold them are read."""

    def __init__(self, folder: str, name: str):
        self.folder, self.name = folder, name
        system, path = files.open_folder(folder)
        size = system.get_file_info(f"{path}/{name}").size
        n_blocks, n_docs, at, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{name} is not a token file")
        index = self._read(at, 8 * (n_blocks + 1) + 17 * n_docs)
        self.starts = np.frombuffer(index, "<u8", n_blocks + 1).astype(np.int64)
        keys = np.frombuffer(index, "<i8", n_docs, 8 * (n_blocks + 1))
        known = np.frombuffer(index, "u1", n_docs, 8 * (n_blocks + 1 + n_docs))
        self.keys = [int(key) if there else None for key, there in zip(keys, known)]
        self.lengths = np.frombuffer(index, "<u8", n_docs, 8 * (n_blocks + 1) + 9 * n_docs).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])

    def _read(self, start: int, size: int) -> bytes:
        return files.read_range(self.folder, self.name, int(start), int(size))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The shard's ids from `start` up to `stop`."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (stop - 1) // BLOCK
        base = self.starts[first]
        data = self._read(base, self.starts[last + 1] - base)
        blocks = [data[self.starts[b] - base : self.starts[b + 1] - base] for b in range(first, last + 1)]
        return decode_blocks(blocks)[start - first * BLOCK : stop - first * BLOCK]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, place of its first id in the shard, ids) of each document, some blocks at a time."""
        step = BLOCKS_AT_ONCE * BLOCK
        held, base = np.zeros(0, np.uint32), 0
        for key, start, length in zip(self.keys, self.offsets[:-1], self.lengths):
            stop = start + length
            if stop > base + len(held):
                upto = min(max(stop, base + len(held) + step), self.offsets[-1])
                more = self.ids(base + len(held), int(upto))
                held, base = np.concatenate([held[start - base :], more]), int(start)
            yield key, int(start), held[start - base : stop - base]


# White space other than a space or a line break, and a mark that the quick way to cut uses for itself.
OTHER_BLANKS = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
MARK = "\0"


def _single_blanks(text: str) -> bool:
    """Whether all white space is single spaces and line breaks between other characters."""
    if not text or text[0] in " \n" or text[-1] in " \n" or any(pair in text for pair in ("  ", " \n", "\n ", "\n\n")):
        return False
    return not any(blank in text for blank in OTHER_BLANKS)


def marked_segments(text: str) -> str:
    """The text with a mark between its segments; the text has no marks."""
    if _single_blanks(text):
        return text.replace("\n", f"{MARK}\n{MARK}").replace(" ", f"{MARK} ")
    return MARK.join(segments_of(text))


def segments_of(text: str) -> list[str]:
    """Parts whose encodings joined are the text's: cut before a single space, and around a single line break, that has
    a non-blank character on both sides. The tokenizer's word rule ends a word there whatever surrounds it, and its
    merges stay inside a word.
    """
    out: list[str] = []
    open_end = False  # the last part takes what follows
    for i, part in enumerate(text.split(" ")):
        if i:
            part = " " + part
            if open_end or len(part) == 1 or part[1].isspace():
                out[-1] += part
                open_end = out[-1][-1].isspace()
                continue
        open_end = part[-1:].isspace() or not part
        if "\n" not in part or open_end:
            out.append(part)
            continue
        lines = part.split("\n")
        if any(not line or line[0].isspace() and (k or line == " ") or line[-1].isspace() for k, line in enumerate(lines)):
            out.append(part)
            continue
        out.append(lines[0])
        for line in lines[1:]:
            out += ("\n", line)
    return out


class IdEncoder:
    """Token ids of texts as bytes, by the tokenizers library, which is asked once for each frequent segment.

    The text of a special token is that token, as by the library's default, or with `special_as_text` ordinary text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        # Segments and their ids as bytes, looked up by Arrow for a whole chunk at once.
        self.known = pa.array([], pa.large_string())
        self.known_ids = pa.array([], pa.large_binary())
        self.uses = np.zeros(0, np.int64)

    def _ask(self, segments: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _ids_of(self, segments: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(ids, place in them of each segment) of different segments; those that are not known are asked for together."""
        at = pc.index_in(segments, value_set=self.known)
        places = at.fill_null(0).to_numpy().astype(np.int64)
        missing = at.is_null()
        is_missing = missing.to_numpy(zero_copy_only=False)
        new = segments.filter(missing)
        new_ids = pa.array(self._ask(new.to_pylist()), pa.large_binary())
        places[is_missing] = len(self.known) + np.arange(len(new))
        ids = pa.concat_arrays([self.known_ids, new_ids])
        self.uses[places[~is_missing]] += 1
        short = pc.less_equal(pc.utf8_length(new), LONGEST_REMEMBERED)
        self._remember(new.filter(short), new_ids.filter(short))
        return ids, places

    def _remember(self, segments: pa.Array, ids: pa.Array) -> None:
        if len(self.known) + len(segments) > REMEMBERED:
            # The half that fewer chunks had goes.
            stay = np.sort(np.argsort(self.uses, kind="stable")[len(self.uses) // 2 :])
            self.known, self.known_ids = self.known.take(pa.array(stay)), self.known_ids.take(pa.array(stay))
            self.uses = self.uses[stay] // 2
        self.known = pa.concat_arrays([self.known, segments])
        self.known_ids = pa.concat_arrays([self.known_ids, ids])
        self.uses = np.append(self.uses, np.zeros(len(segments), np.int64))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of some texts. Each different segment is looked up once, and its ids are copied to all its places."""
        marked = [None if MARK in text else marked_segments(text) for text in texts]
        cut = pc.split_pattern(pa.array([text for text in marked if text is not None], pa.large_string()), MARK)
        coded = cut.flatten().dictionary_encode()
        segment_ends = np.array(cut.offsets) - cut.offsets[0].as_py()
        del cut
        ids, places = self._ids_of(coded.dictionary)
        copied = ids.take(pa.array(places[coded.indices.to_numpy()]))
        _, ends, data = copied.buffers()
        # Where each text's ids end: at the end of its last segment.
        stops = np.frombuffer(ends, np.int64)[copied.offset : copied.offset + len(copied) + 1][segment_ends].tolist()
        whole = memoryview(data) if data is not None else memoryview(b"")
        found = iter([bytes(whole[start:stop]) for start, stop in zip(stops[:-1], stops[1:])])
        return [self._ask([text])[0] if was is None else next(found) for text, was in zip(texts, marked)]


@functools.lru_cache(maxsize=2)
def id_encoder(path: str, special_as_text: bool = False) -> IdEncoder:
    return IdEncoder(path, special_as_text)


def chunks(batch: pa.RecordBatch, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts (column 1) have about `limit` bytes."""
    ends = np.array(pc.binary_length(batch.column(1)), np.int64).cumsum()
    start = 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def write_token_files(
    docs: DataFrame,
    tokenizer_file: str,
    folder: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    special_as_text: bool = False,
) -> DataFrame:
    """Writes all documents in ascending id order and returns the manifest: shard, file, n_docs, n_tokens, start.

    `start` is the number of ids in the shards before. Shards are ranges of ids and of the texts' digests, as many as Spark makes
    partitions for the data's size, so rows without an id or with one id are split too, if their texts differ. Null text counts as empty and has the end id only; a null id comes first; rows that repeat an id stand
    next to each other in the order of their texts. The text of a special token is that token unless `special_as_text`
    is set. An empty table gives an empty manifest or a shard without documents.
    """
    key = F.col(f"`{id_column}`").cast("long")
    inputs = docs.select(key.alias("doc_id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    ordered = inputs.repartitionByRange("doc_id", F.md5("text")).sortWithinPartitions("doc_id", F.md5("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = id_encoder(tokenizer_file, special_as_text)
        end = np.array([END_ID], "<u4").tobytes()
        shard = TaskContext.get().partitionId()
        stream, name = files.write_once(folder, f"part-{shard:06d}")
        writer = ShardWriter(stream)
        for batch in batches:
            for some in chunks(batch):
                for one, ids in zip(some.column(0).to_pylist(), own.encode(some.column(1).to_pylist())):
                    writer.add(one, ids + end)
        writer.close()
        yield pa.record_batch({
            "shard": pa.array([shard], pa.int64()),
            "file": [name],
            "n_docs": pa.array([len(writer.keys)], pa.int64()),
            "n_tokens": pa.array([sum(writer.lengths)], pa.int64()),
        })

    written = stored(ordered.mapInArrow(run, "shard LONG, file STRING, n_docs LONG, n_tokens LONG"), "manifest")
    # One row a shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32, shard, and the shard's blocks and bytes."""
    fields = {
        "doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64(), "shard": pa.int64(),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows = []
                for key, start, ids in ShardReader(folder, row["file"]).documents():
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((key, row["start"] + start, len(ids), crc, row["shard"]))
                columns = list(zip(*rows)) or [[]] * len(fields)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, fields.values())], names=list(fields))

    shards = manifest.select("file", "start", "shard").repartitionById(max(1, manifest.count()), F.col("shard").cast("int"))
    return shards.mapInArrow(run, "doc_id LONG, start LONG, n_tokens LONG, ids_crc32 LONG, shard LONG")


def token_files(spark: SparkSession, docs: DataFrame, tokenizer_file: str, **options: str | bool) -> DataFrame:
    """Writes the documents to a folder of their own under the shared scratch folder and reads the files back."""
    folder = scratch_path(spark, "token-files")
    return read_token_files(write_token_files(docs, tokenizer_file, folder, **options), folder)
