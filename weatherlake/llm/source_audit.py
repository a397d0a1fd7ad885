"""How far the sources of each language diverge, from exact counts of their terms.

Terms are counted in numpy, some megabytes of text at a time, by their packed bytes: a term of up to 8 bytes is one 64-bit
word, one of up to 16 bytes two, and both are sorted by 16-bit digits, the last digit first; longer terms are sorted as bytes, each
length in a bucket of its own. Equal neighbours are runs, whose lengths are the counts. Spark adds the counts up.

All arithmetic is on whole numbers. A share is in billionths: p = 1 + floor(10^9 (count + 1) / (total + vocabulary)).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weatherlake.llm.common import stored
from weatherlake.llm.token_files import chunks

WORD = 8
LEAST_DOCUMENTS = 3
TERM_RANKS = 200

_bytes = np.arange(256, dtype=np.uint8)
# Letters, and every byte of a character beyond ASCII.
IS_TERM = (_bytes >= 0x80) | ((_bytes | 0x20) >= ord("a")) & ((_bytes | 0x20) <= ord("z")) & (_bytes >= 0x40)
LOWER = np.where((_bytes >= ord("A")) & (_bytes <= ord("Z")), _bytes + 32, _bytes).astype(np.uint8)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts without nulls, one after another, and where each starts (with the end of the last)."""
    _, ends, data = texts.buffers()
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(ends, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def term_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, number of the text) of each term, in the order of the texts."""
    inside = IS_TERM[raw]
    # Whether no term reaches over the place before each byte, and after the last.
    cut = np.ones(len(raw) + 1, bool)
    cut[1:] = ~inside
    cut[offsets] = True
    starts = np.flatnonzero(inside & cut[:-1])
    cut = np.append(~inside, True)
    cut[offsets] = True
    ends = np.flatnonzero(inside & cut[1:]) + 1
    return starts, ends - starts, np.searchsorted(offsets, starts, side="right") - 1


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """The stable order by several 64-bit words, the first most significant: one counting sort a 16-bit digit."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digits = (word >> np.uint64(shift)).astype(np.uint16)
            if (digits == digits[:1]).all():
                continue
            order = order[np.argsort(digits[order], kind="stable")]
    return order


def _packed(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Up to 8 bytes from each start as one word, first byte most significant, zeros after the end."""
    words = np.ndarray((len(padded) - WORD + 1,), ">u8", padded, strides=(1,))[starts].astype(np.uint64)
    spare = ((WORD - np.minimum(lengths, WORD)) * 8).astype(np.uint64)
    return words >> spare << spare


def _runs(new: np.ndarray, order: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the runs that `new` marks in the sorted terms, their lengths, and the number of texts in each."""
    starts = np.flatnonzero(new)
    own = texts[order]
    other_text = new.copy()
    other_text[1:] |= own[1:] != own[:-1]
    counts = np.diff(np.append(starts, len(new)))
    return starts, counts, np.add.reduceat(other_text.astype(np.int64), starts)


def count_runs(
    raw: np.ndarray, offsets: np.ndarray, group_of_text: np.ndarray
) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    """(groups, terms, occurrences, texts) of the bytes of some texts, a bucket of term lengths at a time.

    Texts are numbered in ascending order and every sort is stable, so the texts of a run ascend and are counted by
    their changes.
    """
    starts, lengths, texts = term_spans(raw, offsets)
    padded = np.zeros(len(raw) + 2 * WORD, np.uint8)
    padded[: len(raw)] = LOWER[raw]
    for least, most in ((1, WORD), (WORD + 1, 2 * WORD)):
        which = np.flatnonzero((lengths >= least) & (lengths <= most))
        if not len(which):
            continue
        at, length, text = starts[which], lengths[which], texts[which]
        group = group_of_text[text]
        words = [_packed(padded, at, length)]
        if most > WORD:
            words.append(_packed(padded, at + WORD, length - WORD))
        keys = [group.astype(np.uint64), *words]
        order = radix_order(keys)
        new = np.ones(len(order), bool)
        new[1:] = False
        for key in keys:
            ordered = key[order]
            new[1:] |= ordered[1:] != ordered[:-1]
        firsts, counts, in_texts = _runs(new, order, text)
        first = order[firsts]
        found = np.stack([word[first] for word in words], axis=1).astype(">u8")
        yield group[first], np.ascontiguousarray(found).view(f"S{most}").ravel().tolist(), counts, in_texts

    which = np.flatnonzero(lengths > 2 * WORD)
    which = which[np.argsort(lengths[which], kind="stable")]
    cuts = np.flatnonzero(np.diff(lengths[which])) + 1
    for bucket in np.split(which, cuts) if len(which) else ():
        length = int(lengths[bucket[0]])
        text = texts[bucket]
        group = group_of_text[text]
        rows = np.lib.stride_tricks.sliding_window_view(padded, length)[starts[bucket]]
        keys = np.ascontiguousarray(rows).view(f"S{length}").ravel()
        order = np.argsort(keys, kind="stable")
        order = order[np.argsort(group[order], kind="stable")]
        new = np.ones(len(order), bool)
        new[1:] = (keys[order][1:] != keys[order][:-1]) | (group[order][1:] != group[order][:-1])
        firsts, counts, in_texts = _runs(new, order, text)
        first = order[firsts]
        yield group[first], keys[first].tolist(), counts, in_texts


COUNTS = "lang STRING, source STRING, term STRING, n LONG, docs LONG"


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (lang, text, source) rows; each group also gives a row of the empty term and no occurrences."""
    for batch in batches:
        for some in chunks(batch):
            lang, text, source = some.columns
            pairs = pa.StructArray.from_arrays([lang, source], ["lang", "source"])
            langs, sources = lang.dictionary_encode(), source.dictionary_encode()
            codes = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            _, firsts, group_of_text = np.unique(codes, return_index=True, return_inverse=True)
            groups = pairs.take(pa.array(firsts))
            found = [(np.arange(len(firsts)), [b""] * len(firsts), np.zeros(len(firsts), np.int64), np.zeros(len(firsts), np.int64))]
            found += count_runs(*text_bytes(text), group_of_text)
            of = groups.take(pa.array(np.concatenate([part[0] for part in found])))
            terms = pa.array([term for part in found for term in part[1]], pa.binary()).cast(pa.string())
            yield pa.record_batch({
                "lang": of.field("lang").cast(pa.string()),
                "source": of.field("source").cast(pa.string()),
                "term": terms,
                "n": np.concatenate([part[2] for part in found]).astype(np.int64),
                "docs": np.concatenate([part[3] for part in found]).astype(np.int64),
            })


def term_counts(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows with the term); and a row with the empty term for each group."""

    def known(column: str) -> Column:
        return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))

    inputs = docs.select(known(lang_column).alias("lang"), known(text_column).alias("text"), known(source_column).alias("source"))
    counted = inputs.mapInArrow(_count_batches, COUNTS)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, vocabulary: Column) -> Column:
    """A term's share in billionths, at least 1; exact, as the products are decimals of 38 digits."""
    scaled = (count.cast("decimal(20,0)") + 1) * F.lit(1_000_000_000)
    return F.call_function("div", scaled, (total + vocabulary).cast("decimal(20,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _joint_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of what terms that two sources share add to what each source gives alone, by lang and pair of places.

    A row has one lang, `cells` (place, p, share of an absent term) of the sources that have a term, and the number of terms with
    the same cells. Only sums leave a batch.
    """
    for batch in batches:
        lang = batch.column(0).dictionary_encode()
        codes = lang.indices.to_numpy().astype(np.int64)
        cells = batch.column(1)
        sizes = np.diff(np.array(cells.offsets, np.int64))
        flat = cells.flatten()
        place, p, absent = (flat.field(name).to_numpy().astype(np.int64) for name in ("place", "p", "absent"))
        first = np.cumsum(sizes) - sizes
        times = batch.column(2).to_numpy()
        sums: dict[tuple[int, int, int], int] = {}
        for size in np.unique(sizes):
            all_rows = np.flatnonzero(sizes == size)
            for rows in np.array_split(all_rows, -(-len(all_rows) * int(size) // 1_000_000)):
                at = first[rows][:, None] + np.arange(size)
                own, none, where = p[at], absent[at], place[at]
                for k in range(size):
                    p1, p0 = own[:, k : k + 1], none[:, k : k + 1]
                    value = _gap(p1, own) - _gap(p1, none) - _gap(p0, own) + _gap(p0, none)
                    value *= times[rows][:, None]
                    keys = np.stack([np.broadcast_to(codes[rows][:, None], where.shape), np.broadcast_to(where[:, k : k + 1], where.shape), where], axis=-1)
                    pairs, inverse = np.unique(keys.reshape(-1, 3), axis=0, return_inverse=True)
                    totals = np.zeros(len(pairs), np.int64)
                    np.add.at(totals, inverse.ravel(), value.ravel())
                    for pair, total in zip(map(tuple, pairs.tolist()), totals.tolist()):
                        sums[pair] = sums.get(pair, 0) + total
        names = lang.dictionary
        keys = list(sums)
        yield pa.record_batch({
            "lang": names.take(pa.array([key[0] for key in keys], pa.int64())).cast(pa.string()),
            "place": pa.array([key[1] for key in keys], pa.int32()),
            "other": pa.array([key[2] for key in keys], pa.int32()),
            "joint": pa.array([sums[key] for key in keys], pa.int64()),
        })


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def audit(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    term_ranks: int = TERM_RANKS,
) -> DataFrame:
    """lang, source, part, item, value, rank: the divergence of each source from the others of its language, and its terms.

    Part `pair` has a row for each other source of the language, with the sum over the language's kept terms of
    floor((p - q)^2 / q), p the source's share and q the other's. Part `term` has the kept terms that the source has and uses more
    than the language does, q the language's share, up to rank `term_ranks`. Ranks count from 1 by value descending, then by
    the item's bytes. A language keeps the terms in at least `least_documents` of its rows.

    Null text, lang and source count as empty. Rows are counted as they come, repeated ones each. A language without kept terms
    has pairs of value 0; a language with one source has no pairs; an empty table gives an empty result; other columns
    are not read.

    Only counts are shuffled. The sum over all terms is made of what each source gives against an absent term, from its
    histogram of shares, and what shared terms change, which tasks add up for terms with equal shares in equal sources.
    """
    counts = stored(term_counts(docs, text_column, lang_column, source_column), "term-counts")
    cell = F.struct("source", "n")
    by_term = counts.where("term <> ''").groupBy("lang", "term")
    kept = by_term.agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(cell).alias("cells"))
    kept = stored(kept.where(F.col("docs") >= least_documents).drop("docs"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("lang_n").alias("lang_total"))
    totals = kept.select("lang", F.inline("cells")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # One row a source of a language.
    groups = counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0).withColumn(
        "absent", F.when(F.col("vocabulary") > 0, share(F.lit(0), F.col("total"), F.col("vocabulary"))).otherwise(1)
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")).alias("place")
    groups = stored(groups.select("*", place), "source-groups")

    cells = kept.select("lang", "term", "lang_n", F.inline("cells")).join(groups, ["lang", "source"])
    cells = cells.withColumn("p", share(F.col("n"), F.col("total"), F.col("vocabulary")))

    def ranked(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return rows.select("*", F.row_number().over(order).alias("rank"))

    in_lang = cells.withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("vocabulary"))).where("p > q")
    terms = ranked(
        in_lang.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    ).where(F.col("rank") <= term_ranks)

    # Terms with the same shares in the same sources are one row.
    spread = cells.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("place", "p", "absent"))).alias("cells"))
    alike = spread.where(F.size("cells") > 1).groupBy("lang", "cells").agg(F.count("*").alias("times"))
    joint = alike.mapInArrow(_joint_sums, "lang STRING, place INT, other INT, joint LONG")
    joint = joint.groupBy("lang", "place", "other").agg(F.sum("joint").alias("joint"))
    shares = cells.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    shares = shares.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "times")).alias("shares"))
    sides = stored(groups.join(shares, ["lang", "source"], "left"), "source-shares")
    no_shares = F.array().cast("array<struct<p:bigint,times:bigint>>")
    sides = sides.withColumn("shares", F.coalesce("shares", no_shares))
    left = sides.select("lang", "source", "place", "vocabulary", F.col("absent").alias("p0"), F.col("shares").alias("ps"))
    right = sides.select("lang", F.col("source").alias("item"), F.col("place").alias("other"), F.col("absent").alias("q0"), F.col("shares").alias("qs"))
    pairs = left.join(right, "lang").where("place <> other").join(joint, ["lang", "place", "other"], "left")
    base = divergence(F.col("p0"), F.col("q0"))
    alone = F.aggregate("ps", F.lit(0).cast("long"), lambda total, s: total + s["times"] * (divergence(s["p"], F.col("q0")) - base))
    other = F.aggregate("qs", F.lit(0).cast("long"), lambda total, s: total + s["times"] * (divergence(F.col("p0"), s["p"]) - base))
    value = F.col("vocabulary") * base + alone + other + F.coalesce("joint", F.lit(0))
    pair_rows = ranked(pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")))
    return pair_rows.unionByName(terms)
