"""Mixing sources to target weights by thresholds on a hash of the id, found from histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weatherlake.llm.common import HOT_KEYS, packed, stored, word_count

CAP = 3
# Bits of the hash that one histogram resolves, and how many histograms follow each other: 60 bits in all.
BUCKET_BITS = 12
LEVELS = 5


def sized(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """`row` (the input row as a struct), `source`, `size` (words of the text) and `hash`, a non-negative 60-bit number.

    The hash comes from id and text, so rows that repeat both share it and are taken or left together.
    """
    text = F.col(f"`{text_column}`")
    key = F.xxhash64(F.col(f"`{id_column}`"), text)
    return docs.select(
        packed(docs).alias("row"),
        F.col(f"`{source_column}`").alias("source"),
        word_count(text).alias("size"),
        F.shiftrightunsigned(key, 64 - BUCKET_BITS * LEVELS).alias("hash"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = CAP) -> DataFrame:
    """source, source_size, weight, target from source and source_size: one row a source.

    Sources in code point order, null last, take the weights in turn. The targets add up to the sum of all sizes
    and never exceed `cap` times a source's size: above a common level x, target = min(cap * size, x * weight). The
    level rises round by round until no further source reaches its cap; each round is one sum over the sources.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    weighed = stored(sizes.withColumn("weight", weight), "sources")
    limit = cap * F.col("source_size")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        at_cap = limit <= level * F.col("weight")
        capped, n, free = weighed.agg(
            F.sum(F.when(at_cap, limit).otherwise(0)), F.count_if(at_cap), F.sum(F.when(~at_cap, F.col("weight")))
        ).first()
        if n == full or not free:
            break
        full, level = n, (total - capped) / free
    return weighed.withColumn(
        "target", F.when(limit <= level * F.col("weight"), limit.cast("double")).otherwise(F.lit(level) * F.col("weight"))
    )


def _bucket(level: int) -> Column:
    shift = BUCKET_BITS * (LEVELS - 1 - level)
    return F.shiftright("hash", shift).bitwiseAND((1 << BUCKET_BITS) - 1)


def _prefix(level: int) -> Column:
    return F.shiftright("hash", BUCKET_BITS * (LEVELS - level))


def histogram(rows: DataFrame, level: int) -> DataFrame:
    """source, bucket, words: the sum of sizes in each bucket of the level's hash bits."""
    return rows.groupBy("source", _bucket(level).alias("bucket")).agg(F.sum("size").alias("words"))


def thresholds(rows: DataFrame, wanted: DataFrame, first: DataFrame) -> DataFrame:
    """source, whole, below: each document is taken `whole` times, and once more if its hash is under `below`.

    `rows` has source, hash and size, `wanted` has source, source_size and target, `first` is the histogram of level 0.
    The words left after the whole rounds are the budget. Level by level a histogram shows the buckets that fit below
    the budget and the one on the boundary; only rows of the boundary bucket go on to the next level. A larger budget
    gives a higher threshold, so the choice for a smaller budget is part of that for a larger one. The document on
    the boundary is taken if that comes nearer to the budget.
    """
    filled = F.col("source_size") > 0
    whole = F.when(filled, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = wanted.select(
        "source",
        whole.alias("whole"),
        (F.col("target") - whole * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("prefix"),
    )
    counted = first
    for level in range(LEVELS):
        if level:
            rows = stored(
                rows.join(state.select(F.col("source").alias("s"), "prefix"), F.expr("source <=> s"))
                .where(_prefix(level) == F.col("prefix"))
                .select("source", "hash", "size"),
                "boundary",
            )
            counted = histogram(rows, level)
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        cumulated = counted.select(F.col("source").alias("s"), "bucket", upto.alias("upto"))
        fits = F.col("upto") <= F.col("budget")
        state = stored(
            state.join(cumulated, F.expr("source <=> s"), "left")
            .groupBy("source", "whole", "budget", "prefix")
            .agg(
                F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0)).alias("used"),
                F.min(F.when(~fits, F.col("upto"))).alias("over"),
                # The first bucket that does not fit, else the one after the last.
                F.coalesce(F.min(F.when(~fits, F.col("bucket"))), F.max("bucket") + 1, F.lit(0).cast("long")).alias("next"),
            )
            .select(
                "source",
                "whole",
                (F.col("budget") - F.col("used")).alias("budget"),
                (F.col("over") - F.col("used")).alias("step"),
                (F.col("prefix") * (1 << BUCKET_BITS) + F.col("next")).alias("prefix"),
            ),
            f"level{level}",
        )
    nearer = F.col("step") - F.col("budget") < F.col("budget")
    return state.select("source", "whole", (F.col("prefix") + F.coalesce(nearer, F.lit(False)).cast("long")).alias("below"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = CAP, **columns: str) -> DataFrame:
    """Each row of `sized` with source_size, target and `times`, how often the mix takes it (0 to `cap`).

    Null texts and texts without words have size 0; null sources are one source, the last. A source of size 0 has
    target 0. An empty table gives an empty result. Reruns agree, as the choice depends on ids and texts alone.

    The text is read once for the sizes and once for the result; between them only counted buckets, one row a source,
    and the rows of boundary buckets move. Spark broadcasts the table of sources if it is small; else it joins by
    source and splits the partition of a hot one.
    """
    rows = sized(docs, **columns)
    narrow = stored(rows.select("source", "hash", "size"), "sizes")
    first = stored(histogram(narrow, 0), "histogram")
    wanted = targets(first.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
    cuts = thresholds(narrow, wanted, first).select(F.col("source").alias("cut_source"), "whole", "below")
    per_source = stored(
        wanted.join(cuts, F.expr("source <=> cut_source")).select(
            F.col("source").alias("s"), "source_size", "target", "whole", "below"
        ),
        "cuts",
    )
    times = F.least(F.col("whole") + (F.col("hash") < F.col("below")).cast("long"), F.lit(cap))
    return rows.join(per_source, F.expr("source <=> s")).select(
        "row", "source", "size", "source_size", "target", times.alias("times")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = CAP, **columns: str) -> DataFrame:
    """The mixed table with the input's columns; a row taken n times appears n times."""
    taken = mixed(docs, weights, cap, **columns).where(F.col("times") > 0)
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
