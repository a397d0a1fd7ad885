"""Quality rules: plain counts, and the divergence of a text's histograms from those of its language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherlake.llm.common import packed, stored, words

# Frequent words of the languages that have a word histogram.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "as", "with", "was", "on", "are", "by", "be", "it", "this", "from", "or", "at"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "il", "par", "sur", "au", "pas"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una", "su", "al", "lo"],
}
N_COMMON = 20

# Character classes by the characters that are not in them. `other`, what no class holds, is a-z and control characters.
NOT_IN_CLASS = {
    "upper": r"[^A-Z]+",
    "digit": r"[^0-9]+",
    "blank": r"[^\x20\x09-\x0D]+",
    "symbol": r"[^#*$%&|<>]+",
    "mark": r"[^!\x22'()+,\-./:;=?@\[\\\]\^_`{}~]+",
    "wide": r"[\x00-\x7F]+",
}
CLASSES = [*NOT_IN_CLASS, "other"]

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# Shorter texts are not judged by a histogram, and neither is a language with fewer documents than this.
MIN_CLASS_CHARS = 200
MIN_HISTOGRAM_WORDS = 60
MIN_REFERENCE_DOCS = 20
MAX_CLASS_DISTANCE = 0.33
# A language's limit of the word distance, as a share of the distance that a text without common words has.
MAX_WORD_SHARE = 0.8
# Texts that should have fewer common words by the language's reference are not judged by them: so few scatter too much.
MIN_EXPECTED_COMMON = 15


def _left(text: Column, pattern: str) -> Column:
    return F.char_length(F.regexp_replace(text, pattern, "")).cast("long")


def _class(name: str) -> Column:
    return F.get("class_counts", F.lit(CLASSES.index(name)))


def base_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the column `text` (not null).

    The rows have their class_counts.
    """
    col = F.col(text)
    lines = F.filter(F.split(col, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumns({"_words": words(col), "_lines": lines})
    # Hash of each window of five words.
    df = df.withColumn(
        "_hashes",
        F.when(
            F.size("_words") >= WINDOW,
            F.transform(F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, WINDOW))),
        ),
    )
    # Texts without two windows of one hash, nearly all, stop here. In the others equal windows meet by sorting, and
    # windows of one hash are compared word by word.
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    numbered = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), F.slice("_words", i + 1, WINDOW).alias("w"), i.alias("i")))
    df = df.withColumn("_sorted", F.when(repeats, F.sort_array(numbered)))

    def same(s: Column, k: Column) -> Column:
        other = F.get("_sorted", k)
        return F.coalesce((other["h"] == s["h"]) & (other["w"] == s["w"]), F.lit(False))

    again = F.filter("_sorted", lambda s, k: same(s, k - 1) | same(s, k + 1))
    df = df.withColumn("_starts", F.sort_array(F.transform(again, lambda s: s["i"])))
    # A window covers five words, or as many as lie before the next one.
    steps = F.transform("_starts", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - p, F.lit(WINDOW))))
    covered = F.aggregate(steps, F.lit(0), lambda total, step: total + step)
    return df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(col) - _class("blank"),
        "n_symbols": _class("symbol"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
    }).drop("_words", "_lines", "_hashes", "_sorted", "_starts")


def histograms(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Adds class_counts, by CLASSES, and word_counts: the language's common words and, last, all other words.

    word_counts is null for a language without common words.
    """
    col = F.col(text)
    classes = [_left(col, pattern) for pattern in NOT_IN_CLASS.values()]
    df = df.withColumn("_counts", F.array(*classes)).withColumn("class_counts", _with_rest("_counts", F.char_length(col)))
    # Letters and digits in words between two blanks each, so that neighbours share no blank and a literal search finds all.
    spaced = F.concat(F.lit(" "), F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]+", "  "), F.lit(" "))
    df = df.withColumn("_spaced", spaced)
    size = F.octet_length("_spaced")
    counts = F.lit(None).cast("array<bigint>")
    for code, common in COMMON_WORDS.items():
        found = [
            ((size - F.octet_length(F.replace(F.col("_spaced"), F.lit(f" {word} "), F.lit("")))) / len(f" {word} ".encode())).cast("long")
            for word in common
        ]
        counts = F.when(F.col(lang) == code, F.array(*found)).otherwise(counts)
    gaps = F.char_length("_spaced") - F.char_length(F.replace(F.col("_spaced"), F.lit("  "), F.lit(" ")))
    return (
        df.withColumn("_counts", counts).withColumn("word_counts", _with_rest("_counts", gaps + 1)).drop("_counts", "_spaced")
    )


def _total(counts: str) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda total, n: total + n)


def _with_rest(counts: str, whole: Column) -> Column:
    """The counts and what they leave of the whole."""
    return F.concat(F.col(counts), F.array(whole.cast("long") - _total(counts)))


def references(counted: DataFrame, lang: str = "lang") -> DataFrame:
    """The summed histograms of each language (null is one), with its number of documents; names begin with r_.

    They give the language's share of common words and the limit of its word distance.
    """

    def summed(counts: str, bins: int) -> Column:
        return F.array(*[F.sum(F.get(counts, F.lit(i))) for i in range(bins)])

    known = counted.groupBy(F.col(lang).alias("r_lang")).agg(
        F.count("*").alias("r_docs"),
        summed("class_counts", len(CLASSES)).alias("r_class_counts"),
        summed("word_counts", N_COMMON + 1).alias("r_word_counts"),
    )
    without = F.array(*[F.lit(0)] * N_COMMON, F.lit(1))
    known = known.withColumns({"_without": without, "_one": F.lit(1), "_sum": _total("r_word_counts")})
    farthest = jensen_shannon("_without", "_one", "r_word_counts", "_sum")
    return known.withColumns({
        "r_common_share": 1 - F.get("r_word_counts", F.lit(N_COMMON)) / F.nullif(F.col("_sum"), F.lit(0)),
        "r_word_limit": F.round(MAX_WORD_SHARE * farthest, 6),
    }).drop("_without", "_one", "_sum")


def jensen_shannon(left: str, n: str, right: str, m: str) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of counts, with their sums; null if a sum is null or 0."""

    def term(a: Column, b: Column) -> Column:
        p, q = a / F.col(n), b / F.col(m)
        part = lambda x: F.when(x > 0, x * F.log2(x / ((p + q) / 2))).otherwise(0.0)
        return part(p) + part(q)

    divergence = F.aggregate(F.zip_with(left, right, term), F.lit(0.0), lambda total, x: total + x) / 2
    return F.when((F.col(n) > 0) & (F.col(m) > 0), F.sqrt(F.greatest(divergence, F.lit(0.0))))


def verdict(df: DataFrame) -> DataFrame:
    """Adds base_failed, class_distance, word_distance and kept to rows with base counts, histograms and references.

    A distance is null where the text or the language's reference is too small to judge by, or where the language
    has no common words; it then rejects nothing.
    """
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    known = F.col("r_docs") >= MIN_REFERENCE_DOCS
    sums = ("class_counts", "word_counts", "r_class_counts", "r_word_counts")
    df = df.withColumns({f"{name}_sum": _total(name) for name in sums})
    by_class = jensen_shannon("class_counts", "class_counts_sum", "r_class_counts", "r_class_counts_sum")
    by_word = jensen_shannon("word_counts", "word_counts_sum", "r_word_counts", "r_word_counts_sum")
    by_class = F.when(known & (F.col("class_counts_sum") >= MIN_CLASS_CHARS), by_class)
    enough = (F.col("word_counts_sum") >= MIN_HISTOGRAM_WORDS) & (F.col("word_counts_sum") * F.col("r_common_share") >= MIN_EXPECTED_COMMON)
    by_word = F.when(known & enough, by_word)
    df = df.withColumns({
        "base_failed": base_failed,
        "class_distance": F.round(by_class, 6),
        "word_distance": F.round(by_word, 6),
    })
    far = F.coalesce(F.col("class_distance") > MAX_CLASS_DISTANCE, F.lit(False)) | F.coalesce(
        F.col("word_distance") > F.col("r_word_limit"), F.lit(False)
    )
    # One sum, not a conjunction: a filter by it stays above the join. Its part on the base counts would else be moved
    # below them, where it repeats their whole computation.
    against = F.col("base_failed").cast("int") + far.cast("int")
    return df.withColumn("kept", against == 0)


def _inputs(docs: DataFrame, text_column: str, lang_column: str, *more: Column) -> DataFrame:
    return docs.select(
        *more, F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"), F.col(f"`{lang_column}`").alias("lang")
    )


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """One row per input row: doc_id, the base counts, both distances, base_failed and kept.

    Null text counts as empty; a text without words fails the base rules. A null or unknown language has no word
    histogram, and its documents together are the reference of their character classes. Repeated rows are judged
    alike. An empty table gives an empty result. The text is read once; the counts of each row are kept in the shared
    folder, as the references need all of them.
    """
    rows = _inputs(docs, text_column, lang_column, F.col(f"`{id_column}`").alias("doc_id"))
    counted = stored(base_counts(histograms(rows)).drop("text"), "quality")
    known = stored(references(counted), "languages")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept"]
    return verdict(counted.join(known, F.expr("lang <=> r_lang"), "left")).select("doc_id", *names)


def keep_good(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """The rows that pass, with the input's columns. The text is read twice: for the references, and to judge it."""
    rows = _inputs(docs, text_column, lang_column, packed(docs).alias("row"))
    known = stored(references(histograms(rows.drop("row"))), "languages")
    judged = verdict(base_counts(histograms(rows)).join(known, F.expr("lang <=> r_lang"), "left"))
    return judged.where("kept").select("row.*")
