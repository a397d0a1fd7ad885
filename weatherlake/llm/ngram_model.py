"""An interpolated modified Kneser-Ney bigram model, counted in Spark and kept in sorted hash arrays.

Words are 64-bit hashes. The vocabulary is one sorted array of them, cut by their first bits into files; a word's id is
its place. A pair of ids is one number, scrambled by a one-to-one mapping so that equal ranges of numbers hold
equal shares of the pairs, and the bigrams are again one sorted array in files by range. Counts by word stand in arrays
by id. Scoring maps the files into memory and looks words and pairs up in sorted order.

The order is two: with three, the sorted arrays and what is shuffled to make them exceed four times the input.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherlake.llm import files
from weatherlake.llm.common import stored
from weatherlake.session import scratch_path

# The end of a text is a token; no word holds a blank.
END = xxhash.xxh3_64_intdigest(b" end")
# Tokens that are looked up at once, and keys that a task holds before it sends their counts.
CHUNK_TOKENS = 400_000
HELD_KEYS = 3_000_000
MAX_WORDS = 1 << 32
BLOBS = "kind INT, part INT, blob BINARY, file STRING, n LONG, wide BOOLEAN, n1 LONG, n2 LONG, n3 LONG, n4 LONG"


# --- documents and tokens


def tokens_of(text: str | None) -> list[int]:
    """Hashes of the words, A-Z lower-cased, and of the end."""
    # On bytes, lower() changes A-Z only and split() parts at the six ASCII blanks.
    hashes = list(map(xxhash.xxh3_64_intdigest, (text or "").encode().lower().split()))
    hashes.append(END)
    return hashes


def held_out(key: int | None) -> bool:
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


def chunks(batches: Iterator[pa.RecordBatch], training_only: bool) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(ids of the documents, place of each one's first token, token hashes) for some documents at a time."""
    keys: list = []
    lengths: list[int] = []
    tokens: list[int] = []

    def chunk():
        return keys, np.concatenate([[0], np.cumsum(lengths[:-1])]).astype(np.int64), np.array(tokens, np.uint64)

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if training_only and held_out(key):
                continue
            own = tokens_of(text.as_py())
            keys.append(key)
            lengths.append(len(own))
            tokens += own
            if len(tokens) >= CHUNK_TOKENS:
                yield chunk()
                keys, lengths, tokens = [], [], []
    if keys:
        yield chunk()


# --- counted keys


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length; the first is sorted and stored as differences. Bytes of one place stand together."""
    first, *rest = columns
    planes = [np.diff(first, prepend=first.dtype.type(0)), *rest]
    raw = b"".join(c.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in planes)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(blob: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(columns, 8, -1)
    first, *rest = [np.ascontiguousarray(c.T).view("<u8").ravel() for c in raw]
    return [np.cumsum(first, dtype=np.uint64), *rest]


def summed(keys: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """Equal keys become one, in order, with the sums of their columns."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return [keys[first], *(np.add.reduceat(c[order], first) if len(first) else c for c in columns)]


def by_part(parts: int, shift: int, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(part, packed columns) for each part that has keys; a key's part is what is left of it after the shift."""
    keys = columns[0]
    cuts = np.searchsorted(keys, np.arange(1, parts, dtype=np.uint64) << np.uint64(shift))
    for part, own in enumerate(zip(*(np.split(c, cuts) for c in columns))):
        if len(own[0]):
            yield part, pack(*own)


def counted(streams: Iterator[np.ndarray], parts: int, shift: int) -> Iterator[pa.RecordBatch]:
    """Counts keys and gives a packed row for each part; equal keys of a task are one, up to HELD_KEYS."""
    held: list[list[np.ndarray]] = []
    n = 0

    def merged():
        return summed(*(np.concatenate(c) for c in zip(*held)))

    def rows(keys, counts):
        found = list(by_part(parts, shift, keys, counts))
        return pa.record_batch({"part": pa.array([p for p, _ in found], pa.int32()), "blob": pa.array([b for _, b in found], pa.binary())})

    for keys in streams:
        unique, counts = np.unique(keys, return_counts=True)
        held.append([unique, counts.astype(np.uint64)])
        n += len(unique)
        if n > HELD_KEYS:
            held = [merged()]
            n = len(held[0][0])
            if n > HELD_KEYS // 2:
                yield rows(*held[0])
                held, n = [], 0
    if held:
        yield rows(*merged())


class Gathered:
    """Adds up packed rows of the parts that a task gets, some rows at a time."""

    def __init__(self, columns: int):
        self.columns = columns
        self.parts: dict[int, list[list[np.ndarray]]] = {}

    def add(self, part: int, blob: bytes) -> None:
        held = self.parts.setdefault(part, [])
        held.append(unpack(blob, self.columns))
        if len(held) > 64:
            held[:] = [summed(*(np.concatenate(c) for c in zip(*held)))]

    def __iter__(self):
        for part, held in sorted(self.parts.items()):
            yield part, summed(*(np.concatenate(c) for c in zip(*held)))


def few_counts(counts: np.ndarray) -> dict[str, int]:
    """How many counts are 1, 2, 3 and 4."""
    return {f"n{k}": int((counts == k).sum()) for k in range(1, 5)}


def write_array(folder: str, name: str, *columns: np.ndarray) -> str:
    stream, unique = files.write_once(folder, name)
    with stream:
        for column in columns:
            stream.write(column.tobytes())
    return unique


def row(**values) -> pa.RecordBatch:
    names = {"kind": pa.int32(), "part": pa.int32(), "blob": pa.binary(), "file": pa.string(), "n": pa.int64(), "wide": pa.bool_()}
    names |= {f"n{k}": pa.int64() for k in range(1, 5)}
    return pa.record_batch({name: pa.array([values.get(name)], kind) for name, kind in names.items()})


# --- the files


class Pairs:
    """One number for two ids, and its scrambled form; both maps are one-to-one."""

    def __init__(self, words: int):
        if words + 1 >= MAX_WORDS:
            raise ValueError("the vocabulary has too many words for a pair to fit 64 bits")
        self.half = np.uint64(max(1, int(words + 1).bit_length()))
        self.bits = int(2 * self.half)
        self.mask = np.uint64((1 << self.bits) - 1)
        factor = 0x9E3779B97F4A7C15 & int(self.mask) | 1
        self.factor, self.inverse = np.uint64(factor), np.uint64(pow(factor, -1, 1 << self.bits))

    def key(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        x = left << self.half | right
        x = ((x ^ x >> self.half) * self.factor) & self.mask
        return x ^ x >> self.half

    def ids(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = ((key ^ key >> self.half) * self.inverse) & self.mask
        x = x ^ x >> self.half
        return x >> self.half, x & np.uint64((1 << int(self.half)) - 1)


class SortedFiles:
    """A sorted array in files by range, mapped into memory; each key has one count."""

    def __init__(self, folder: str, listed: list, shift: int):
        self.folder, self.shift = folder, np.uint64(shift)
        self.listed = listed  # (part, file, n, wide)
        self.first_key = np.array([part for part, *_ in listed], np.uint64) << self.shift
        self.offsets = np.concatenate([[0], np.cumsum([n for _, _, n, _ in listed])]).astype(np.int64)

    @functools.lru_cache(maxsize=None)  # noqa: B019  one object lives as long as its worker
    def arrays(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        _, name, n, wide = self.listed[i]
        path = files.local_copy(self.folder, name)
        return np.memmap(path, "<u8", "r", 0, (n,)), np.memmap(path, "<u8" if wide else "<u4", "r", 8 * n, (n,))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place or -1, count or 0) of each key; the keys are sorted."""
        places, counts = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        cuts = np.append(np.searchsorted(keys, self.first_key), len(keys))
        for i, (start, stop) in enumerate(zip(cuts[:-1], cuts[1:])):
            if start == stop:
                continue
            own, held = self.arrays(i)
            at = np.minimum(np.searchsorted(own, keys[start:stop]), len(own) - 1)
            hit = own[at] == keys[start:stop]
            places[start:stop][hit] = at[hit] + self.offsets[i]
            counts[start:stop][hit] = held[at[hit]]
        return places, counts


class ByWord:
    """Arrays by word id in files of `size` words: count after the word as context, how many followers were seen
    once, twice, more often, and how many words the word was seen after."""

    COLUMNS = 5

    def __init__(self, folder: str, listed: list, size: int):
        self.folder, self.size, self.names = folder, size, dict(listed)

    @functools.lru_cache(maxsize=None)  # noqa: B019
    def arrays(self, part: int) -> np.ndarray:
        return np.memmap(files.local_copy(self.folder, self.names[part]), "<u8", "r", 0, (self.COLUMNS, self.size))

    def get(self, ids: np.ndarray) -> np.ndarray:
        """One row per id, which are sorted; -1 has zeros."""
        out = np.zeros((len(ids), self.COLUMNS))
        parts = ids // self.size
        for part in np.unique(parts[ids >= 0]):
            if part in self.names:
                which = slice(*np.searchsorted(parts, [part, part + 1]))
                out[which] = self.arrays(int(part))[:, ids[which] - part * self.size].T
        return out


def word_ids(words: SortedFiles, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id or -1, count) of each token."""
    unique, back = np.unique(tokens, return_inverse=True)
    places, counts = words.find(unique)
    return places[back], counts[back]


def contexts(ids: np.ndarray, starts: np.ndarray, start_id: int) -> np.ndarray:
    before = np.concatenate([[0], ids[:-1]])
    before[starts] = start_id
    return before


def discounts(n: list[int]) -> list[float]:
    """What is taken from counts of 1, 2 and more, from how many counts are 1, 2, 3 and 4.

    Where one of them is 0 the estimate doesn't exist; halves of the counts are taken then.
    """
    if not all(n[:4]):
        return [0.5, 1.0, 1.5]
    share = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * share * n[k] / n[k - 1] for k in (1, 2, 3)]
    return [d if 0 <= d <= k else k / 2 for k, d in zip((1, 2, 3), found)]


class Model:
    """The model's files and how it scores."""

    def __init__(self, folder: str, name: str):
        system, path = files.open_folder(folder)
        with system.open_input_stream(f"{path}/{name}") as file:
            about = json.loads(file.read())
        self.about = about
        self.size, self.total = about["words"], about["tokens"]
        self.pairs = Pairs(self.size)
        self.words = SortedFiles(folder, about["word_files"], about["word_shift"])
        self.bigrams = SortedFiles(folder, about["pair_files"], about["pair_shift"])
        self.by_word = ByWord(folder, about["by_word_files"], about["by_word_size"])
        self.pair_discounts = np.array([0.0, *about["pair_discounts"]])
        self.word_discounts = np.array([0.0, *about["word_discounts"]])
        after = about["after_counts"]  # words seen after 1, 2, more words; and the number of bigrams
        self.bigram_types = about["bigram_types"]
        self.word_rest = float(np.dot(self.word_discounts[1:], after)) / max(1, self.bigram_types)

    def word_probability(self, after: np.ndarray) -> np.ndarray:
        """From how many words each word was seen after; 0 for an unknown word."""
        uniform = 1 / (self.size + 1)
        if not self.bigram_types:
            return np.full(len(after), uniform)
        kept = after - self.word_discounts[np.minimum(after, 3).astype(int)]
        return kept / self.bigram_types + self.word_rest * uniform

    def probabilities(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Of each token after the one before it, or after the start of its text."""
        before = contexts(ids, starts, self.size)
        unique, back = np.unique(ids, return_inverse=True)
        lower = self.word_probability(self.by_word.get(unique)[:, 4])[back]
        unique, back = np.unique(before, return_inverse=True)
        total, once, twice, more, _ = self.by_word.get(unique)[back].T
        count = np.zeros(len(ids), np.int64)
        both = np.flatnonzero((ids >= 0) & (before >= 0))
        keys, back = np.unique(
            self.pairs.key(before[both].astype(np.uint64), ids[both].astype(np.uint64)), return_inverse=True
        )
        count[both] = self.bigrams.find(keys)[1][back]
        kept = count - self.pair_discounts[np.minimum(count, 3)]
        rest = once * self.pair_discounts[1] + twice * self.pair_discounts[2] + more * self.pair_discounts[3]
        known = np.maximum(total, 1)
        return np.where(total > 0, kept / known + rest / known * lower, lower)


@functools.lru_cache(maxsize=1)
def model(folder: str, name: str) -> Model:
    """One model for a worker process."""
    return Model(folder, name)


@functools.lru_cache(maxsize=1)
def vocabulary(folder: str, listed: tuple, shift: int) -> SortedFiles:
    return SortedFiles(folder, listed, shift)


# --- counting


def _parts(docs: DataFrame) -> int:
    """A power of two, at least as many as the session's shuffle partitions."""
    return 1 << max(0, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


def train(docs: DataFrame, folder: str) -> str:
    """Counts the training documents (doc_id, text) into files in `folder`; the name of the file that lists them.

    Each task adds up its own counts before they are shuffled, so a frequent word or pair is one entry a task. What comes
    to the driver is one line a file and eight sums.
    """
    parts = _parts(docs)
    word_shift = 64 - (parts.bit_length() - 1)

    def count_words(batches):
        yield from counted((tokens for _, _, tokens in chunks(batches, True)), parts, word_shift)

    def write_words(batches):
        gathered = Gathered(2)
        for batch in batches:
            for part, blob in zip(*(c.to_pylist() for c in batch.columns)):
                gathered.add(part, blob)
        for part, (keys, counts) in gathered:
            name = write_array(folder, f"words-{part:06d}", keys, counts)
            yield row(kind=0, part=part, file=name, n=len(keys), n1=int(counts.sum()))

    blobs = docs.mapInArrow(count_words, "part INT, blob BINARY").repartitionById(parts, "part")
    listed = stored(blobs.mapInArrow(write_words, BLOBS), "words")
    word_files = tuple((r.part, r.file, r.n, True) for r in listed.orderBy("part").collect())
    words = sum(n for _, _, n, _ in word_files)
    tokens = listed.agg(F.sum("n1")).first()[0] or 0

    pairs = Pairs(words)
    pair_shift = max(0, pairs.bits - (parts.bit_length() - 1))
    own_size = -(-(words + 1) // parts)

    def count_pairs(batches):
        known = vocabulary(folder, word_files, word_shift)

        def keys():
            for _, starts, hashes in chunks(batches, True):
                ids, _ = word_ids(known, hashes)
                yield pairs.key(contexts(ids, starts, words).astype(np.uint64), ids.astype(np.uint64))

        yield from counted(keys(), parts, pair_shift)

    def write_pairs(batches):
        gathered = Gathered(2)
        for batch in batches:
            for part, blob in zip(*(c.to_pylist() for c in batch.columns)):
                gathered.add(part, blob)
        for part, (keys, counts) in gathered:
            wide = bool(counts.max() >= 1 << 32)
            name = write_array(folder, f"pairs-{part:06d}", keys, counts if wide else counts.astype("<u4"))
            yield row(kind=0, part=part, file=name, n=len(keys), wide=wide, **few_counts(counts))
            left, right = pairs.ids(keys)
            one = np.ones(len(keys), np.uint64)
            seen = [(counts == k).astype(np.uint64) for k in (1, 2)]
            after = summed(left, counts, seen[0], seen[1], one)
            for kind, columns in ((1, after), (2, summed(right, one))):
                cuts = np.searchsorted(columns[0], np.arange(1, parts, dtype=np.uint64) * np.uint64(own_size))
                for own, cut in enumerate(zip(*(np.split(c, cuts) for c in columns))):
                    if len(cut[0]):
                        yield row(kind=kind, part=own, blob=pack(*cut))

    blobs = docs.mapInArrow(count_pairs, "part INT, blob BINARY").repartitionById(parts, "part")
    counted_pairs = stored(blobs.mapInArrow(write_pairs, BLOBS), "pairs")
    listed = counted_pairs.where("kind = 0")
    pair_files = [(r.part, r.file, r.n, r.wide) for r in listed.orderBy("part").collect()]
    pair_few = listed.agg(*[F.sum(f"n{k}") for k in range(1, 5)]).first()

    def write_by_word(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for kind, part, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if part not in held:
                    held[part] = np.zeros((ByWord.COLUMNS, own_size), np.uint64)
                columns = unpack(blob, 5 if kind == 1 else 2)
                at = (columns[0] - np.uint64(part * own_size)).astype(np.int64)
                if kind == 1:
                    total, once, twice, types = columns[1:]
                    for i, values in enumerate((total, once, twice, types - once - twice)):
                        held[part][i, at] += values
                else:
                    held[part][4, at] += columns[1]
        for part, values in held.items():
            name = write_array(folder, f"by-word-{part:06d}", values)
            few = few_counts(values[4])
            yield row(kind=0, part=part, file=name, n=int((values[4] >= 3).sum()), **few)

    partial = counted_pairs.where("kind > 0").select("kind", "part", "blob").repartitionById(parts, "part")
    listed = stored(partial.mapInArrow(write_by_word, BLOBS), "by-word")
    by_word_files = [(r.part, r.file) for r in listed.orderBy("part").collect()]
    after = listed.agg(F.sum("n1"), F.sum("n2"), F.sum("n3"), F.sum("n4"), F.sum("n")).first()

    about = {
        "words": words,
        "tokens": tokens,
        "word_files": word_files,
        "word_shift": word_shift,
        "pair_files": pair_files,
        "pair_shift": pair_shift,
        "by_word_files": by_word_files,
        "by_word_size": own_size,
        "bigram_types": sum(n for _, _, n, _ in pair_files),
        "pair_discounts": discounts([x or 0 for x in pair_few]),
        "word_discounts": discounts([x or 0 for x in after[:4]]),
        "after_counts": [after[0] or 0, after[1] or 0, after[4] or 0],
    }
    stream, name = files.write_once(folder, "model")
    with stream:
        stream.write(json.dumps(about).encode())
    return name


def score(docs: DataFrame, folder: str, name: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of each document (doc_id, text)."""
    fields = {
        "doc_id": pa.int64(),
        "held_out": pa.bool_(),
        "n_tokens": pa.int64(),
        "n_known": pa.int64(),
        "train_tokens": pa.int64(),
        "base_score": pa.float64(),
        "score": pa.float64(),
        "perplexity": pa.float64(),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(folder, name)
        for keys, starts, tokens in chunks(batches, False):
            ids, counts = word_ids(own.words, tokens)
            base = np.log10((counts + 1) / (own.total + own.size + 1))
            logs = np.log10(own.probabilities(ids, starts))
            n = np.diff(np.append(starts, len(tokens)))
            scores = np.add.reduceat(logs, starts)
            columns = [
                keys,
                [held_out(key) for key in keys],
                n,
                np.add.reduceat((counts > 0).astype(np.int64), starts),
                np.full(len(keys), own.total),
                np.add.reduceat(base, starts),
                scores,
                10 ** (-scores / n),
            ]
            yield pa.record_batch({f: pa.array(c, t) for c, (f, t) in zip(columns, fields.items())})

    types = (
        "doc_id LONG, held_out BOOLEAN, n_tokens LONG, n_known LONG, train_tokens LONG, "
        "base_score DOUBLE, score DOUBLE, perplexity DOUBLE"
    )
    return docs.mapInArrow(run, types)


def train_and_score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Learns from the documents that are not held out and scores all; one row per input row.

    A document is held out if crc32 of its id as text, mod 7, is 2; one without an id is not. Null text counts as empty:
    its one token is the end. Repeated rows count as often as they occur. Without training tokens every token has
    probability 1, as the uniform share of the one unknown word. An empty table gives an empty result; other
    columns are not read.
    """
    inputs = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    folder = scratch_path(docs.sparkSession, "ngrams")
    return score(inputs, folder, train(inputs, folder))
