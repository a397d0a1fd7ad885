"""Merge-type SentencePiece encoding by a table of last tokens, and decoding with the library.

The encoding of a text's prefix is a prefix of nothing but itself: if t1..tn is the encoding of a text, t1..ti is that of
the characters they cover. So each prefix has one last token, and a token that ends there is the one if the
tokens before it are the encoding of what is left, which only depends on the two tokens at the seam: they are
compatible if encoding their joined characters gives the two back. An automaton lists the vocabulary's pieces that end at
each character; the compatible one is stored; ids are then read off backwards. The work is linear in the text.

Segments that a worker does not remember are many at a time, so they go through the same steps side by side: the automaton
is then a table of transitions, the last tokens a matrix, and a pair's test is looked up by the pair's number.
"""

from __future__ import annotations

import functools
import hashlib
import math
import sys
from collections.abc import Iterator
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from weatherlake.llm.cache import Recent
from weatherlake.llm.common import in_parts, release_memory

BLANK = "▁"
NORMAL, CONTROL_END, BYTE = 1, "</s>", 6
ID = np.dtype("<i4")
# Frequent segments that a worker remembers, and the longest that it does.
REMEMBERED = 200_000
LONGEST_REMEMBERED = 48
PAIRS = 200_000
# Bytes of text that are cut into segments at once.
CHUNK_BYTES = 4 << 20
# Segments encoded side by side, and the number from which that is faster than one by one.
SIDE_BY_SIDE = 1 << 14
FEW = 64
# Slots for pairs that were tested, and the odd factor that spreads them (2 ** 64 by the golden ratio).
PAIR_SLOT_BITS = 21
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PieceEncoder:
    """Encodes as the library does with a merge-type model without normalisation rules."""

    def __init__(self, model_file: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("only merge-type models that leave the text as it is are supported")
        if any(p.type not in (NORMAL, 2, 3, BYTE) for p in model.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.dummy_prefix = spec.add_dummy_prefix
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.end = self.library.piece_to_id(CONTROL_END)
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.fallback = model.trainer_spec.byte_fallback
        self.unknown = self.library.unk_id()

        self.halves: dict[str, tuple[str, str]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in self.scores:
            # A piece that its own characters do not merge into is never made.
            *_, halves, whole = [[], *self.merges(piece)]
            if whole == [piece]:
                self.automaton.add_word(piece, piece)
                if len(piece) > 1:
                    self.halves[piece] = tuple(halves)
        self.automaton.make_automaton()
        self.edges: dict[tuple[str, int], list[tuple[str, float]] | None] = {}
        # No piece has a blank after another character, so no merge crosses that seam; the same with a line break if no piece has one.
        self.cut_blanks = not any(BLANK in piece.lstrip(BLANK) for piece in self.scores)
        self.cut_lines = self.cut_blanks and not any("\n" in piece for piece in self.scores)
        self.compatible = Recent(self._compatible, PAIRS)
        self.remembered = Recent(self._encode, REMEMBERED)
        self._number_tokens()

    def _number_tokens(self) -> None:
        """The tables for many segments at once.

        Tokens are numbered: 0 is any character that no piece has, then come the characters of pieces, then longer pieces.
        """
        characters = sorted(set("".join(self.scores)))
        self.tokens = ["", *characters, *self.halves]
        self.token_sizes = np.array([1, *map(len, self.tokens[1:])])
        self.token_ids = np.array([self.ids.get(token, -1) for token in self.tokens])
        self.longest = int(self.token_sizes.max())
        self.character_tokens = np.zeros(sys.maxunicode + 1, np.int32)
        self.character_tokens[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        # Node n is reached by token n's character while n is a character, so the first step needs no table.
        numbers = {c: n for n, c in enumerate(characters, 1)}
        self.width = len(characters) + 1
        steps: dict[int, int] = {}
        ends = list(range(self.width))
        for token, piece in enumerate(self.tokens[self.width :], self.width):
            node = numbers[piece[0]]
            for character in piece[1:]:
                step = node * self.width + numbers[character]
                node = steps.setdefault(step, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = token
        found = sorted(steps)
        self.node_tokens = np.array(ends)
        # The last entry is larger than any step and ends the search.
        self.steps = np.array([*found, np.iinfo(np.int64).max])
        self.step_nodes = np.array([*(steps[step] for step in found), 0])
        self.tested = np.full(1 << PAIR_SLOT_BITS, -1)

    def merges(self, text: str) -> Iterator[list[str]]:
        """The parts of a short text before and after each merge: the best score first, the leftmost of equals."""
        parts = list(text)
        scores = self.scores
        yield list(parts)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            yield list(parts)

    def edge(self, piece: str, side: int) -> list[tuple[str, float]] | None:
        """What stands at the piece's left (0) or right (1) end as it grows from one character, with scores.

        None if the scores do not fall at each step, as then the merges are not made in this order.
        """
        known = self.edges.get((piece, side), False)
        if known is not False:
            return known
        if len(piece) == 1:
            found = [(piece, math.inf)]
        else:
            halves = self.halves[piece]
            inner = [self.edge(half, side) for half in halves]
            score = self.scores[piece]
            falls = all(inner) and all(score < self.scores.get(half, math.inf) or len(half) == 1 for half in halves)
            found = [*inner[side], (piece, score)] if falls else None
        self.edges[piece, side] = found
        return found

    def _compatible(self, pair: tuple[str, str]) -> bool:
        """Whether the two tokens' joined characters are encoded as the two.

        Follows the growth of both ends at the seam; they are not if what stands there would at some time merge across
        it before either end grows on. Of equal scores the merge further left is made first.
        """
        left, right = self.edge(pair[0], 1), self.edge(pair[1], 0)
        if left is None or right is None:
            *_, parts = self.merges(pair[0] + pair[1])
            return parts == [*pair]
        scores = self.scores
        i = j = 0
        while True:
            next_left = left[i + 1][1] if i + 1 < len(left) else -math.inf
            next_right = right[j + 1][1] if j + 1 < len(right) else -math.inf
            across = scores.get(left[i][0] + right[j][0])
            if across is not None and across > next_left and across >= next_right:
                return False
            if next_left == next_right == -math.inf:
                return True
            if next_left >= next_right:
                i += 1
            else:
                j += 1

    def last_tokens(self, text: str) -> list[str]:
        """For each prefix of the text the last token of its encoding."""
        last: list[str] = [""] * (len(text) + 1)
        compatible = self.compatible
        reached = 0
        for end, piece in self.automaton.iter(text):
            end += 1
            while reached < end - 1:  # no piece ends here
                reached += 1
                if not last[reached]:
                    last[reached] = text[reached - 1]
            if last[end]:
                continue
            start = end - len(piece)
            if start == 0 or compatible[last[start], piece]:
                last[end] = piece
        for at in range(1, len(text) + 1):
            if not last[at]:
                last[at] = text[at - 1]
        return last

    def pieces(self, text: str) -> list[str]:
        last, at, found = self.last_tokens(text), len(text), []
        while at:
            found.append(last[at])
            at -= len(last[at])
        return found[::-1]

    def _compatible_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pair test for numbers of tokens; a slot holds the number of the last pair tested there, and its result."""
        pairs = left * len(self.tokens) + right
        slots = self._slots(pairs)
        known = self.tested[slots]
        good = (known & 1).astype(bool)
        missing = np.flatnonzero(known >> 1 != pairs)
        if len(missing):
            new, where = np.unique(pairs[missing], return_inverse=True)
            tokens, results = self.tokens, []
            for pair in new.tolist():
                a, b = divmod(pair, len(tokens))
                results.append(not a or self._compatible((tokens[a], tokens[b])))
            results = np.array(results)
            good[missing] = results[where]
            self.tested[self._slots(new)] = new << 1 | results
        return good

    def _slots(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint64) * SPREAD >> np.uint64(64 - PAIR_SLOT_BITS)).astype(np.int64)

    def _last_tokens_of_all(self, lengths: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """The last token of each prefix by length (rows) and segment (columns), of which the longest are first.

        `characters` are the tokens of single characters by position and segment, 0 behind a segment's end.
        """
        longest = int(lengths[0])
        last = np.full((longest + 1, len(lengths)), -1)
        # Segments of at least each length.
        reaching = np.searchsorted(-lengths, -np.arange(longest + 2), "right")
        for start in range(longest + 1):
            before = last[start]
            if start:
                unset = np.flatnonzero(before[: reaching[start]] < 0)
                before[unset] = characters[start - 1, unset]
            which = np.arange(reaching[start + 1])
            node = characters[start, which]
            for end in range(start + 1, min(start + self.longest, longest) + 1):
                if end == start + 1:
                    on = np.flatnonzero(node)
                    which, node = which[on], node[on]
                else:
                    step = node * self.width + characters[end - 1, which]
                    at = np.searchsorted(self.steps, step)
                    on = np.flatnonzero(self.steps[at] == step)
                    which, node = which[on], self.step_nodes[at[on]]
                if not len(which):
                    break
                token = self.node_tokens[node]
                ends = np.flatnonzero(token >= 0)
                segment, token = which[ends], token[ends]
                if start:
                    good = np.flatnonzero(self._compatible_pairs(before[segment], token))
                    segment, token = segment[good], token[good]
                last[end, segment] = token
        return last

    def _encode_side_by_side(self, segments: list[str]) -> list[bytes]:
        """As `_encode` for each segment, none of them empty."""
        found: list[bytes] = [b""] * len(segments)
        order = np.argsort([-len(s) for s in segments], kind="stable").tolist()
        for at in range(0, len(order), SIDE_BY_SIDE):
            some = order[at : at + SIDE_BY_SIDE]
            for i, ids in zip(some, self._encode_some([segments[i] for i in some])):
                found[i] = ids
        return found

    def _encode_some(self, segments: list[str]) -> Iterator[bytes]:
        lengths = np.array([len(s) for s in segments])
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        columns = np.repeat(np.arange(len(segments)), lengths)
        rows = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        characters = np.zeros((int(lengths[0]) + 1, len(segments)), np.int64)
        characters[rows, columns] = self.character_tokens[codes]
        last = self._last_tokens_of_all(lengths, characters)

        left, unread = lengths.copy(), np.arange(len(segments))
        counts = np.zeros(len(segments), np.int64)
        read = []
        while len(unread):
            tokens = last[left[unread], unread]
            read.append((unread, tokens))
            counts[unread] += 1
            left[unread] -= self.token_sizes[tokens]
            unread = unread[left[unread] > 0]
        stops = np.cumsum(counts)
        ordered = np.empty(int(stops[-1]), np.int64)
        for back, (which, tokens) in enumerate(read, 1):
            ordered[stops[which] - back] = tokens
        ids, sizes = self.token_ids[ordered], self.token_sizes[ordered]
        # Segments with characters that are no piece are spelled out.
        odd = set(np.searchsorted(stops, np.flatnonzero(ids < 0), "right").tolist())
        packed, start = ids.astype(ID).tobytes(), 0
        for i, stop in enumerate(stops.tolist()):
            if i in odd:
                cuts = [0, *np.cumsum(sizes[start:stop]).tolist()]
                yield self._ids([segments[i][a:b] for a, b in pairwise(cuts)])
            else:
                yield packed[start * ID.itemsize : stop * ID.itemsize]
            start = stop

    def _encode(self, segment: str) -> bytes:
        return self._ids(self.pieces(segment))

    def _ids(self, pieces: list[str]) -> bytes:
        ids = []
        for piece in pieces:
            if piece in self.ids:
                ids.append(self.ids[piece])
            elif self.fallback:
                ids += [self.bytes[b] for b in piece.encode()]
            else:
                ids.append(self.unknown)
        return np.array(ids, ID).tobytes()

    def _cuts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where segments of texts begin, and the end. `data` are the texts' bytes, `bounds` where they begin and end.

        A segment is a run of blanks with what follows up to a blank or line break, a run of line breaks, or what stands before
        the first blank or after line breaks.
        """
        cut = np.zeros(len(data) + 1, bool)
        cut[bounds] = True
        if self.cut_blanks:
            mark = BLANK.encode()
            blanks = np.flatnonzero(data[: len(data) - len(mark) + 1] == mark[0])
            for i, byte in enumerate(mark):
                blanks = blanks[data[blanks + i] == byte]
            cut[blanks[np.diff(blanks, prepend=-len(mark) - 1) != len(mark)]] = True
        if self.cut_lines:
            breaks = np.flatnonzero(data == ord("\n"))
            cut[breaks[np.diff(breaks, prepend=-2) != 1]] = True
            cut[breaks[np.diff(breaks, append=len(data) + 1) != 1] + 1] = True
        return np.flatnonzero(cut)

    def _encode_different(self, segments: list[str]) -> list[bytes]:
        """The ids of each segment; they are different, so each is looked up or encoded once."""
        found = self.remembered.find(segments)
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = [segments[i] for i in missing if len(segments[i]) <= LONGEST_REMEMBERED]
        made = dict(zip(new, self._encode_side_by_side(new) if len(new) >= FEW else map(self._encode, new)))
        self.remembered.put_all(made)
        for i in missing:
            found[i] = made[segments[i]] if segments[i] in made else self._encode(segments[i])
        return found

    def encode(self, text: str) -> list[int]:
        """The ids of a text, without begin or end ids."""
        return next(self.encode_all(pa.array([text], pa.large_string())))

    def encode_all(self, texts: pa.Array) -> Iterator[list[int]]:
        """Each text's ids, without begin or end ids; a null text has none."""
        texts = texts.cast(pa.large_string()).fill_null("")
        part = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // CHUNK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
        for a, b in pairwise(cuts):
            yield from self._encode_chunk(texts.slice(a, b - a))

    def _encode_chunk(self, texts: pa.Array) -> Iterator[list[int]]:
        marked = pc.replace_substring(texts, " ", BLANK)
        if self.dummy_prefix:
            blank, nothing = pa.scalar(BLANK, pa.large_string()), pa.scalar("", pa.large_string())
            marked = pc.if_else(pc.equal(marked, nothing), nothing, pc.binary_join_element_wise(blank, marked, nothing))
        sizes = pc.binary_length(marked).to_numpy(zero_copy_only=False)
        bounds = np.append(0, np.cumsum(sizes)).astype(np.int64)
        if not bounds[-1]:
            yield from ([] for _ in sizes)
            return
        _, offsets, values = marked.buffers()
        first = int(np.frombuffer(offsets, np.int64)[marked.offset])
        data = np.frombuffer(values, np.uint8)[first : first + int(bounds[-1])]
        cuts = self._cuts(data, bounds)
        segments = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data))
        segments = segments.dictionary_encode()
        found = self._encode_different(segments.dictionary.to_pylist())

        # The ids of the different segments stand one after another and are picked for each place where one occurs.
        ids = np.frombuffer(b"".join(found), ID)
        counts = np.array([len(one) // ID.itemsize for one in found])
        which = segments.indices.to_numpy()
        places = counts[which]
        ends = np.cumsum(places)
        picked = ids[np.arange(ends[-1]) + np.repeat((np.cumsum(counts) - counts)[which] - (ends - places), places)]
        stops = np.append(0, ends)[np.searchsorted(cuts, bounds)].tolist()
        for a, b in pairwise(stops):
            yield picked[a:b].tolist()

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@functools.lru_cache(maxsize=2)
def encoder(model_file: str) -> PieceEncoder:
    """One encoder for a worker process, with what it remembers."""
    return PieceEncoder(model_file)


def encode_documents(
    docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256, and with `with_ids` ids and decoded.

    The ids end with the end id. Null text counts as empty and has that id only. Rows are independent: repeated rows give
    repeated results, an empty table an empty one, and other columns are not read. The model file must be at the same
    path on all executors.
    """
    fields = [
        pa.field("doc_id", pa.int64()),
        pa.field("n_tokens", pa.int64()),
        pa.field("ids_sha256", pa.string()),
        pa.field("decoded_sha256", pa.string()),
    ]
    if with_ids:
        fields += [pa.field("ids", pa.list_(pa.int32())), pa.field("decoded", pa.string())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        own = encoder(model_file)
        names = [str(i) for i in range(own.library.get_piece_size())]
        for batch in in_parts(batches):
            rows: list[list] = [[] for _ in fields]
            for key, ids in zip(batch.column(0).to_pylist(), own.encode_all(batch.column(1))):
                ids.append(own.end)
                decoded = own.decode(ids)
                digest = hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest()
                row = [key, len(ids), digest, hashlib.sha256(decoded.encode()).hexdigest(), ids, decoded]
                for column, value in zip(rows, row):
                    column.append(value)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, fields)], schema=schema)

    types = "doc_id LONG, n_tokens LONG, ids_sha256 STRING, decoded_sha256 STRING"
    if with_ids:
        types += ", ids ARRAY<INT>, decoded STRING"
    inputs = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    return inputs.mapInArrow(run, types)
