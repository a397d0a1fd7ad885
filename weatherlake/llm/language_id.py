"""The language of web pages: the text's likelihood, the declared language, the address's suffix and the host's prior.

For a page with evidence e1, e2, ... the chance of a language is in proportion to the host's prior for it and the
chance of each piece of evidence under it. The text model is fitted on labelled documents; how far a declared language
or a suffix can be trusted, and what a host writes, is summed up over all pages by what their own texts say. A host's
prior leans on that of its domain, and that on all pages, the more the fewer pages it has; a page's own text is
taken out of its host's and domain's sums, as it counts already.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherlake.llm.common import stored

# Runs of GRAM bytes are counted in this many buckets. With MAX_LANGUAGES this bounds the model: 64 MB. More labels than
# that are an error; none is left out.
GRAM = 4
BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
MAX_LANGUAGES = 1000
# Runs overlap, so each counts for a part of the evidence, and no text for more than this many runs.
RUN_WEIGHT = 1 / GRAM
MAX_RUNS = 400
# Weights of the prior's next level, in pages, and of the overall shares in the tables of declarations and suffixes.
HOST_STRENGTH = 4.0
DOMAIN_STRENGTH = 8.0
TABLE_STRENGTH = 2.0

# Starts of parts that are not shown, with what ends each.
HIDDEN_NAMES = ("script", "style", "nav", "header", "footer", "aside", "template", "noscript")
HIDDEN = re.compile(rf"(?is)(<!--)|<({'|'.join(HIDDEN_NAMES)})\b|(<div class=.?ad\b)")
HIDDEN_ENDS = {name: re.compile(rf"(?i)</{name}\s*>") for name in HIDDEN_NAMES} | {"comment": re.compile("-->"), "ad": re.compile("(?i)</div>")}
HTML_TAG, META_TAG = re.compile(r"(?i)<html\b"), re.compile(r"(?i)<meta\b")
LANG = re.compile(r"(?i)\blang\s*=\s*(?:[\"']\s*)?([a-z]{2,3})\b")
CONTENT_LANGUAGE = re.compile("(?i)content-language")
CONTENT = re.compile(r"(?i)content\s*=\s*(?:[\"']\s*)?([a-z]{2,3})\b")
NOT_LETTERS = re.compile(r"[\W\d_]+")
# Character references by number: zeros in front, and numbers beyond any character.
ZEROS, TOO_LARGE = re.compile(r"&#0+(?=\d)"), re.compile(r"&#\d{8,};?")
# Labels below a country's suffix under which names are given out.
SECOND_LEVEL = {"ac", "co", "com", "edu", "go", "gob", "gov", "gv", "net", "ne", "nom", "or", "org"}


def without_hidden(page: str) -> str:
    """The page with each hidden part as one space. A part without an end is not hidden.

    Every byte is looked at once for each kind at most: where a kind's end is not found, there is none further on.
    """
    out, at, look = [], 0, 0
    endless: set[str] = set()
    while (start := HIDDEN.search(page, look)) is not None:
        kind = "comment" if start[1] else start[2].lower() if start[2] else "ad"
        end = None if kind in endless else HIDDEN_ENDS[kind].search(page, start.end())
        if end is None:
            endless.add(kind)
            look = start.end()
        else:
            out += (page[at : start.start()], " ")
            at = look = end.end()
    return "".join([*out, page[at:]])


def without_tags(page: str) -> str:
    """The page with each tag as one space; what follows a last < without > is text."""
    out, at = [], 0
    while (start := page.find("<", at)) >= 0 and (end := page.find(">", start)) >= 0:
        out += (page[at:start], " ")
        at = end + 1
    return "".join([*out, page[at:]])


def visible_text(page: str) -> str:
    """The text a reader sees, without navigation and advertisements; linear in the page."""
    text = without_tags(without_hidden(page))
    return html.unescape(TOO_LARGE.sub("\ufffd", ZEROS.sub("&#", text)))


def _tags(page: str, opening: re.Pattern) -> Iterator[tuple[int, int]]:
    """Where the attributes of such tags start and end; a tag inside another unclosed one counts as part of it."""
    at = 0
    while (start := opening.search(page, at)) is not None:
        end = page.find(">", start.end())
        at = end if end >= 0 else len(page)
        yield start.end(), at


def declared_language(page: str) -> str | None:
    """The lang of the html tag, else the language that a meta tag gives; linear in the page."""
    for start, end in _tags(page, HTML_TAG):
        if found := LANG.search(page, start, end):
            return found[1].lower()
    for start, end in _tags(page, META_TAG):
        named = CONTENT_LANGUAGE.search(page, start, end)
        if named and (found := CONTENT.search(page, named.end(), end)):
            return found[1].lower()
    return None


def address(url: str | None) -> tuple[str | None, str | None, str | None]:
    """(host, domain, suffix) of a URL. None for what is not an address.

    The domain is the name that was given out: the last two labels, or three if the last but one is a level below a
    country's suffix.
    """
    try:
        host = (urlsplit(url or "").hostname or "").rstrip(".")
    except ValueError:
        host = ""
    if not host:
        return None, None, None
    labels = host.split(".")
    given = 3 if len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in SECOND_LEVEL else 2
    return host, ".".join(labels[-given:]), labels[-1]


def runs(text: str) -> np.ndarray:
    """How often each bucket's byte runs occur in the text's letters."""
    data = np.frombuffer((" " + NOT_LETTERS.sub(" ", text.lower()) + " ").encode(), np.uint8).astype(np.uint32)
    if len(data) < GRAM:
        return np.zeros(BUCKETS, np.int64)
    total = np.zeros(len(data) - GRAM + 1, np.uint32)
    for k in range(GRAM):
        total = (total ^ data[k : k + len(total)]) * np.uint32(0x9E3779B1)
    return np.bincount(total >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS)


class TextModel:
    """Log chances of the buckets by language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        counts = counts + 0.5
        self.logs = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)

    def log_likelihoods(self, text: str) -> np.ndarray:
        """For each language, less the largest."""
        found = runs(text)
        n = found.sum()
        if not len(self.languages) or not n:
            return np.zeros(len(self.languages))
        at = np.flatnonzero(found)
        logs = self.logs[:, at] @ found[at] * (min(1.0, MAX_RUNS / n) * RUN_WEIGHT)
        return logs.astype(np.float64) - logs.max()


def fit_text_model(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> TextModel:
    """Counts the byte runs of all labelled documents by language.

    Each task adds up its own counts, and Spark adds those of the tasks. Every label is a language, however rare; the
    model has a row for each, and more than MAX_LANGUAGES raise an error.
    """
    label = F.col(f"`{lang_column}`")
    labels = docs.where(label.isNotNull()).select(label.alias("lang")).distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(labels) > MAX_LANGUAGES:
        raise ValueError(f"{lang_column} has more than {MAX_LANGUAGES} different labels, the most that the text model holds")
    languages = sorted(row.lang for row in labels)
    place = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if lang in place:
                    i = place[lang]
                    found = runs(text.as_py() or "")
                    held[i] = held[i] + found if i in held else found
        for i, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.record_batch({"i": pa.array(np.full(len(at), i), pa.int32()), "bucket": pa.array(at, pa.int32()), "n": pa.array(counts[at], pa.int64())})

    counts = np.zeros((len(languages), BUCKETS))
    if languages:
        summed = docs.select(label.alias("lang"), F.col(f"`{text_column}`").alias("text")).mapInArrow(count, "i INT, bucket INT, n LONG")
        table = summed.groupBy("i", "bucket").agg(F.sum("n").alias("n")).toArrow()
        counts[table["i"].to_numpy(), table["bucket"].to_numpy()] = table["n"].to_numpy()
    return TextModel(languages, counts)


def evidence(pages: DataFrame, text_model: TextModel) -> DataFrame:
    """What each page says by itself: page_id, host, domain, suffix, declared, likelihoods and shares by language."""
    shared = pages.sparkSession.sparkContext.broadcast(text_model)
    names = ["page_id", "host", "domain", "suffix", "declared", "n_chars", "likelihoods", "shares"]
    types = [pa.int64(), *[pa.string()] * 4, pa.int64(), *[pa.list_(pa.float64())] * 2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for key, url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                source = page.as_py() or ""
                text = visible_text(source).strip()
                likelihoods = own.log_likelihoods(text)
                shares = np.exp(likelihoods) / max(1e-300, np.exp(likelihoods).sum())
                row = (key, *address(url), declared_language(source), len(text), likelihoods, shares)
                for column, value in zip(columns, row):
                    column.append(value)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    ddl = (
        "page_id LONG, host STRING, domain STRING, suffix STRING, declared STRING, n_chars LONG, "
        "likelihoods ARRAY<DOUBLE>, shares ARRAY<DOUBLE>"
    )
    return pages.mapInArrow(run, ddl)


def summed_shares(rows: DataFrame, *keys: str, shares: str = "shares", pages: Column | None = None, size: int) -> DataFrame:
    """The sums of the shares by key, and the number of pages; each task adds up its own first."""
    sums = F.array(*[F.sum(F.get(shares, F.lit(i))) for i in range(size)])
    return rows.groupBy(*keys).agg(sums.alias("shares"), (F.count("*") if pages is None else F.sum(pages)).alias("pages"))


def identify(
    pages: DataFrame, text_model: TextModel, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """One row per input row: page_id, lang, probability, text_lang, declared, host, suffix, n_chars.

    A page without text has no likelihood and follows its other evidence; one without an address has the prior of all
    pages, one without a declaration no evidence of that kind. All declarations that are not languages of the model count
    as values like any other. Of equal probabilities the first language in order wins. Repeated rows count as often as
    they occur and get equal results; without labelled documents lang is null; an empty table gives an empty result.

    The sums by host are one row a host. Spark joins them back by broadcast if the table is small, else by host, where it
    splits the partition of a host with many pages.
    """
    size = len(text_model.languages)
    inputs = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        F.col(f"`{url_column}`").alias("url"),
        F.col(f"`{html_column}`").alias("html"),
    )
    seen = stored(evidence(inputs, text_model), "evidence")
    if not size:
        null = F.lit(None).cast("string")
        return seen.select("page_id", null.alias("lang"), F.lit(0.0).alias("probability"), null.alias("text_lang"), "declared", "host", "suffix", "n_chars")

    hosts = stored(summed_shares(seen.where("host is not null"), "host", "domain", size=size), "hosts")
    domains = stored(summed_shares(hosts, "domain", pages=F.col("pages"), size=size), "domains")
    declared = stored(summed_shares(seen.where("declared is not null"), "declared", size=size), "declared")
    suffixes = stored(summed_shares(seen.where("suffix is not null"), "suffix", size=size), "suffixes")
    overall = summed_shares(seen, size=size).first()
    every = np.array([x or 0.0 for x in overall.shares])
    prior = (every + 1) / (every.sum() + size)

    def named(table: DataFrame, key: str) -> DataFrame:
        return table.select(F.col(key).alias(f"{key}_key"), F.col("shares").alias(f"{key}_shares"), F.col("pages").alias(f"{key}_pages"))

    joined = seen
    for table, key in ((hosts, "host"), (domains, "domain"), (declared, "declared"), (suffixes, "suffix")):
        joined = joined.join(named(table, key), F.col(key) == F.col(f"{key}_key"), "left").drop(f"{key}_key")

    languages = text_model.languages

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows

            def matrix(name, batch=batch, n=n):
                return np.array([x if x is not None else [0.0] * size for x in batch.column(name).to_pylist()]).reshape(n, size)

            own = matrix("shares")
            likelihoods = matrix("likelihoods")
            # Priors from the widest level to the host, each without the page itself.
            level = np.broadcast_to(prior, (n, size))
            for key, strength in (("domain", DOMAIN_STRENGTH), ("host", HOST_STRENGTH)):
                there = np.array(batch.column(f"{key}_pages").is_valid())[:, None]
                others = np.maximum(matrix(f"{key}_shares") - own, 0)
                level = np.where(there, (others + strength * level) / (others.sum(axis=1, keepdims=True) + strength), level)
            total = np.log(level) + likelihoods
            for key in ("declared", "suffix"):
                there = np.array(batch.column(f"{key}_pages").is_valid())[:, None]
                others = np.maximum(matrix(f"{key}_shares") - own, 0)
                share = others.sum(axis=1, keepdims=True) / max(1.0, every.sum())
                chance = (others + TABLE_STRENGTH * (share + 1e-9)) / (np.maximum(every - own, 0) + TABLE_STRENGTH)
                total += np.where(there, np.log(chance), 0)
            chances = np.exp(total - total.max(axis=1, keepdims=True))
            chances /= chances.sum(axis=1, keepdims=True)
            best = chances.argmax(axis=1)
            yield pa.record_batch({
                "page_id": batch.column("page_id"),
                "lang": pa.array([languages[i] for i in best], pa.string()),
                "probability": pa.array(np.round(chances[np.arange(n), best], 9), pa.float64()),
                "text_lang": pa.array([languages[i] for i in likelihoods.argmax(axis=1)], pa.string()),
                **{name: batch.column(name) for name in ("declared", "host", "suffix", "n_chars")},
            })

    return joined.mapInArrow(
        fuse,
        "page_id LONG, lang STRING, probability DOUBLE, text_lang STRING, declared STRING, host STRING, suffix STRING, n_chars LONG",
    )
