"""Near duplicates by min-max hashing: the least and the greatest hash of a set under each permutation, in bands."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherlake.llm.common import in_parts, stored

WORDS = 5
SIMILAR_PERCENT = 75
SEED = 20240901
# A bucket of no more nodes is compared in full.
SMALL = 16
# An element that more sets than this list among their rarest says little about who is similar.
LONG_LIST = 64
# Elements of the sets that are compared with each other at once.
BLOCK = 1 << 16
# Values of a document that are hashed at once under all permutations.
CHUNK = 8192


@dataclass(frozen=True)
class Bands:
    """Each permutation gives two values, so a signature has 2 * permutations of them, cut into bands of `rows`.

    A pair of similarity s shares no band with probability (1 - s ** rows) ** bands: 5e-6 at 0.75 for 32 bands of 4.
    """

    permutations: int = 64
    rows: int = 4

    @property
    def bands(self) -> int:
        return 2 * self.permutations // self.rows


# A sketch has one bit of each of these values. At similarity s two sketches agree in a bit with probability (1 + s) / 2.
SKETCH = Bands(permutations=256, rows=1)
# Pairs may differ in this many standard deviations more bits than expected at the limit: 1 in 50 million do at the limit.
DEVIATIONS = 5.5
# For nodes of crowded buckets: a pair of similarity 0.75 shares no band with probability 3e-6, one of 0.4 with 0.92.
LONG_BANDS = Bands(permutations=480, rows=8)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """The distinct 64-bit hashes of the text's runs of five words, sorted; A-Z are lower-cased first.

    A text of fewer words has its whole sequence as the one element; a null text or one without words has none.
    """
    # On bytes, lower() changes A-Z only and split() parts at the six ASCII blanks.
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    width = min(WORDS, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = (total * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[k : k + len(total)]
        total = total * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(_mixed(total))


class Signer:
    def __init__(self, shape: Bands):
        self.shape = shape
        numbers = np.random.default_rng(SEED)
        draw = lambda n: numbers.integers(0, 1 << 64, n, dtype=np.uint64)
        self.factors = draw(shape.permutations) | np.uint64(1)
        self.offsets = draw(shape.permutations)
        self.places = draw(shape.bands * shape.rows).reshape(shape.bands, shape.rows) | np.uint64(1)

    def signature(self, elements: np.ndarray) -> np.ndarray:
        """(bands, rows) values of a set that isn't empty."""
        least = greatest = None
        for start in range(0, len(elements), CHUNK):
            permuted = elements[start : start + CHUNK, None] * self.factors + self.offsets
            low, high = permuted.min(axis=0), permuted.max(axis=0)
            least = low if least is None else np.minimum(least, low)
            greatest = high if greatest is None else np.maximum(greatest, high)
        # Least and greatest alternate, so that a band has both ends of few permutations.
        return _mixed(np.stack([least, greatest], axis=1).reshape(self.shape.bands, self.shape.rows))

    def bands(self, elements: np.ndarray) -> np.ndarray:
        """One 64-bit key for each band of the signature."""
        keys = (self.signature(elements) * self.places).sum(axis=1, dtype=np.uint64)
        return _mixed(keys + np.arange(self.shape.bands, dtype=np.uint64))

    def sketch(self, elements: np.ndarray) -> np.ndarray:
        """One bit of each value of the signature, in 64-bit words."""
        return np.packbits((self.signature(elements) & np.uint64(1)).astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, shape: Bands, id_column: str, text_column: str) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits of the set; null if empty) and bands (null if empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(shape)
        for batch in in_parts(batches):
            sizes, keys, bands = [], [], []
            for text in batch.column(1):
                elements = shingles(text.as_py())
                sizes.append(len(elements))
                keys.append(xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None)
                bands.append(signer.bands(elements).view(np.int64) if len(elements) else None)
            yield pa.record_batch({
                "doc_id": batch.column(0),
                "n_shingles": pa.array(sizes, pa.int64()),
                "set_key": pa.array(keys, pa.binary()),
                "bands": pa.array(bands, pa.list_(pa.int64())),
            })

    inputs = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    return inputs.mapInArrow(run, "doc_id LONG, n_shingles LONG, set_key BINARY, bands ARRAY<LONG>")


def shingle_sets(docs: DataFrame, nodes: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """node, its set and its sketch, for the documents whose ids are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(SKETCH)
        for batch in in_parts(batches):
            keys, sets = batch.column(0).to_pylist(), [shingles(text.as_py()) for text in batch.column(1)]
            # A row that only shares a node's id may have no words.
            rows = [(key, own) for key, own in zip(keys, sets) if len(own)]
            yield pa.record_batch({
                "node": pa.array([key for key, _ in rows], pa.int64()),
                "elements": pa.array([own.view(np.int64) for _, own in rows], pa.list_(pa.int64())),
                "sketch": pa.array([signer.sketch(own) for _, own in rows], pa.list_(pa.int64())),
            })

    inputs = docs.select(F.col(f"`{id_column}`").cast("long").alias("node"), F.col(f"`{text_column}`").alias("text"))
    wanted = inputs.join(nodes, "node", "left_semi")
    return wanted.mapInArrow(run, "node LONG, elements ARRAY<LONG>, sketch ARRAY<LONG>")


def sketches_agree(left: str, right: str, percent: int) -> Column:
    """Whether two sketches differ in no more bits than those of sets of this similarity do."""
    bits = 2 * SKETCH.permutations
    differ = (1 - percent / 100) / 2
    limit = int(bits * differ + DEVIATIONS * (bits * differ * (1 - differ)) ** 0.5)
    counts = [F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(bits // 64)]
    return reduce(add, counts) <= limit


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets share at least `percent` of their union."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b")
    counted = both.select(
        "a", "b", F.size(F.array_intersect("of_a", "of_b")).alias("shared"), (F.size("of_a") + F.size("of_b")).alias("sizes")
    )
    return counted.where(100 * F.col("shared") >= percent * (F.col("sizes") - F.col("shared"))).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for all nodes of the edges (a, b).

    Alternates two steps until nothing changes: each node passes the smallest of its neighbours and itself to its
    larger neighbours, then to its smaller ones. Each step is a sum by node and a join, both over edges alone.
    """
    edges = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    while True:
        # Edges point from the larger node a to the smaller node b.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        large = edges.select(F.col("b").alias("a"), F.col("a").alias("larger")).join(least, "a")
        grown = stored(large.select(F.col("larger").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large-star")
        least = grown.groupBy("a").agg(F.min("b").alias("m"))
        inner = grown.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stored(inner.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        # A forest of stars: every node that has a smaller one has exactly one, and that has none.
        done = after.groupBy("a").count().where("count > 1").isEmpty() and after.join(
            after.select(F.col("a").alias("b")), "b", "left_semi"
        ).isEmpty()
        if done:
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = after


def with_components(active: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return active.withColumn("component", F.col("node"))
    return active.join(roots, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")


def open_rows(active: DataFrame) -> DataFrame:
    """The rows (bucket, node, n, sketch, component) of buckets with more than one component, with the bucket's first node and size."""
    stats = active.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("node").alias("first"), F.count("*").alias("held")
    )
    several = stats.where("low <> high").select("bucket", "first", "held")
    return stored(active.join(several, "bucket"), "active")


class Tried:
    """The pairs whose sets have been compared, so that no pair is compared twice."""

    def __init__(self, sets: DataFrame, percent: int):
        self.sets, self.percent = sets, percent
        self.pairs: DataFrame | None = None

    def links(self, pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b), a > b, those not tried before whose sets are similar."""
        new = pairs.distinct()
        if self.pairs is not None:
            new = new.join(self.pairs, ["a", "b"], "left_anti")
        new = stored(new, "pairs")
        self.pairs = new if self.pairs is None else self.pairs.unionByName(new)
        return stored(confirmed(new, self.sets, self.percent), "links")


def compared(active: DataFrame, leads: Column, tried: Tried) -> DataFrame:
    """Confirmed links of the nodes of each bucket with those that lead it, where the components differ."""
    marked = active.withColumn("leads", leads)
    leaders = marked.where("leads").select(
        "bucket",
        F.col("node").alias("b"),
        F.col("n").alias("n_b"),
        F.col("sketch").alias("sketch_b"),
        F.col("component").alias("c_b"),
    )
    # Sets whose sizes differ more cannot be similar enough; two leaders are compared once.
    near = (
        (F.col("component") != F.col("c_b"))
        & (100 * F.least("n", "n_b") >= tried.percent * F.greatest("n", "n_b"))
        & (~F.col("leads") | (F.col("node") < F.col("b")))
        & sketches_agree("sketch", "sketch_b", tried.percent)
    )
    pairs = marked.join(leaders, "bucket").where(near).select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b"))
    return tried.links(pairs)


def rarest_elements(sets: DataFrame, percent: int) -> DataFrame:
    """node, n, element, place, listed: the rarest elements of each set, as far as they can decide.

    All sets are put in one order, by how many sets have an element. Of two sets that share `percent` of their union, the first
    shared element is among the first (100 - percent) % of the larger one and the first n - 2 percent n / (100 + percent) of
    the smaller one, which lists those. Elements of one set alone come first and are only counted.
    """
    elements = sets.select("node", F.size("elements").alias("n"), F.explode("elements").alias("element"))
    often = elements.groupBy("element").agg(F.count("*").alias("times")).where("times > 1")
    shared = elements.join(often, "element").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("times", "element"))).alias("shared"))
    alone = F.col("n") - F.size("shared")
    probed = F.expr(f"n - ({percent} * n + 99) div 100 + 1").cast("int")
    listed = F.expr(f"n - ({2 * percent} * n + {99 + percent}) div {100 + percent} + 1").cast("int")
    first = shared.select("node", "n", alone.alias("alone"), listed.alias("upto"), F.slice("shared", F.lit(1), F.greatest(probed - alone, F.lit(0))).alias("shared"))
    rows = first.select("node", "n", "alone", "upto", F.posexplode("shared").alias("k", "one"))
    place = (F.col("alone") + F.col("k")).alias("place")
    return rows.select("node", "n", F.col("one.element").alias("element"), place, (F.col("alone") + F.col("k") < F.col("upto")).alias("listed"))


def pairs_by_elements(first: DataFrame, components_of: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components whose first shared element allows enough others after it, from `rarest_elements`."""
    listed = first.where("listed").select("element", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("place").alias("place_b"))
    rest = F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b"))  # with the shared element
    enough = (100 + percent) * rest >= percent * (F.col("n") + F.col("n_b"))
    larger = (F.col("n_b") < F.col("n")) | ((F.col("n_b") == F.col("n")) & (F.col("b") < F.col("node")))
    met = first.join(listed, "element").where(larger & (100 * F.col("n_b") >= percent * F.col("n")) & enough)
    pairs = met.select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct()
    for name in ("a", "b"):
        own = components_of.join(sketches, "node").select(F.col("node").alias(name), F.col("component").alias(f"c_{name}"), F.col("sketch").alias(f"sketch_{name}"))
        pairs = pairs.join(own, name)
    return pairs.where((F.col("c_a") != F.col("c_b")) & sketches_agree("sketch_a", "sketch_b", percent)).select("a", "b")


def merged(roots: DataFrame | None, links: DataFrame) -> DataFrame | None:
    if links.isEmpty():
        return roots
    if roots is not None:
        links = links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
    return components(links)


def band_rows(nodes: DataFrame) -> DataFrame:
    """bucket, node, n for the bands that two nodes or more agree in, from node, n and bands."""
    placed = stored(nodes.select("node", "n", F.explode("bands").alias("bucket")), "bands")
    shared = placed.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    return stored(placed.join(shared.where("first <> last").select("bucket"), "bucket"), "in-shared-bands")


def signed_again(sets: DataFrame, shape: Bands) -> DataFrame:
    """node, n and bands of another shape, from node and elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(shape)
        for batch in in_parts(batches):
            elements = [np.array(e.values).view(np.uint64) for e in batch.column(1)]
            yield pa.record_batch({
                "node": batch.column(0),
                "n": pa.array([len(e) for e in elements], pa.int64()),
                "bands": pa.array([signer.bands(e).view(np.int64) for e in elements], pa.list_(pa.int64())),
            })

    return sets.select("node", "elements").mapInArrow(run, "node LONG, n LONG, bands ARRAY<LONG>")


def first_matches(table: pa.Table, percent: int) -> pa.Table:
    """For each of the outsiders of a block, a member that it is similar to, if there is one."""
    outside = np.array(table["outside"])
    nodes = np.array(table["node"])
    lists = table["elements"].combine_chunks()
    values, offsets = np.array(lists.flatten()), np.array(lists.value_lengths()).cumsum()
    starts, sizes = np.concatenate([[0], offsets[:-1]]), np.array(lists.value_lengths())
    members = np.flatnonzero(~outside)
    held = np.concatenate([values[starts[i] : offsets[i]] for i in members])
    owners = np.repeat(np.arange(len(members)), sizes[members])
    order = np.argsort(held, kind="stable")
    held, owners = held[order], owners[order]
    found = []
    for i in np.flatnonzero(outside):
        own = values[starts[i] : offsets[i]]
        low, high = np.searchsorted(held, own), np.searchsorted(held, own, side="right")
        n = high - low
        at = np.repeat(high - n.cumsum(), n) + np.arange(n.sum())  # all places from low to high
        shared = np.bincount(owners[at], minlength=len(members))
        similar = np.flatnonzero(100 * shared >= percent * (sizes[i] + sizes[members] - shared))
        if len(similar):
            found.append((nodes[i], nodes[members[similar[0]]]))
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def links_to_groups(outsiders: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of outsiders (component, node) to the members (component, node) of components that they may belong to.

    Each outsider is compared with all members, in blocks of about BLOCK elements of both; one link is enough, so rows
    are sets dealt to blocks and links found, never pairs.
    """
    sides = []
    for rows, is_outside in ((members, False), (outsiders, True)):
        whole = stored(rows.join(sets.select("node", "elements"), "node"), "group-sets")
        parts = whole.groupBy("component").agg(F.ceil(F.sum(F.size("elements")) / BLOCK).cast("int").alias("parts"))
        # Stored, so that Spark knows its size and sends it to the rows rather than a large component to one task.
        sides.append((whole, stored(parts, "group-parts"), is_outside))
    dealt = []
    for (whole, own, is_outside), (_, other, _) in zip(sides, reversed(sides)):
        both = whole.join(own, "component").join(other.withColumnRenamed("parts", "others"), "component")
        part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
        across = F.explode(F.sequence(F.lit(0), F.col("others") - 1))
        placed = both.select("component", "node", "elements", part.alias("own"), across.alias("other"))
        names = ("row", "column") if is_outside else ("column", "row")
        dealt.append(
            placed.select(
                "component", F.col("own").alias(names[0]), F.col("other").alias(names[1]), F.lit(is_outside).alias("outside"), "node", "elements"
            )
        )
    groups = dealt[0].unionByName(dealt[1]).groupBy("component", "row", "column")
    return stored(groups.applyInArrow(lambda table: first_matches(table, percent), "a LONG, b LONG"), "links")


def linked(nodes: DataFrame, docs: DataFrame, percent: int, id_column: str, text_column: str) -> DataFrame | None:
    """node, root for the nodes that have links, or None if no two nodes share a band.

    `nodes` has node, n and bands. A bucket holds the nodes that agree in a band. First all are compared with the
    bucket's first node, which brings groups of near copies together at one comparison a node; a bucket whose nodes are
    in one component is done. Of the others the small ones are compared in full. The nodes of large ones, which are half
    alike by what many documents have in common, meet again in bands so long that half-alike sets hardly
    share any. Where such a bucket has nodes of a large component, the nodes of other components in it are compared with
    that component as a whole. Those of small components are compared if they share one of their rarest elements, which
    the templates that many documents have in common are not. Only sets that are made of frequent elements alone are
    left: their buckets are compared with ever more of their nodes until each is in one component or wholly compared. No
    pair is compared twice but with a component as a whole.
    """
    rows = band_rows(nodes)
    candidates = stored(rows.select("node").distinct(), "candidates")
    if candidates.isEmpty():
        return None
    sets = stored(shingle_sets(docs, candidates, id_column, text_column), "sets")
    sketches = sets.select("node", "sketch")
    tried = Tried(sets, percent)
    rows = stored(rows.join(sketches, "node"), "with-sketches")
    is_first, is_small = F.col("node") == F.col("first"), F.col("held") <= SMALL

    active = open_rows(with_components(rows, None))
    roots = merged(None, compared(active, is_first, tried))
    active = open_rows(with_components(rows, roots))
    # Components are as the first links made them until all further links are found.
    crowd = stored(active.where(~is_small).select("node", "component").distinct(), "crowd")
    links = compared(active.where(is_small), F.lit(True), tried)
    if crowd.isEmpty():
        return merged(roots, links)

    own_sets = stored(sets.join(crowd, "node", "left_semi"), "crowd-sets")
    rows = stored(band_rows(signed_again(own_sets, LONG_BANDS)).join(sketches, "node"), "with-sketches")
    large = crowd.groupBy("component").agg(F.count("*").alias("members")).where(F.col("members") > SMALL)
    large = large.select("component", F.lit(True).alias("is_large"))
    active = with_components(rows, roots).join(large, "component", "left")
    active = open_rows(active.withColumn("is_large", F.coalesce("is_large", F.lit(False))))
    groups = active.where("is_large").select("bucket", F.col("component").alias("group")).distinct()
    # Of two large components the nodes of one are compared with the other.
    apart = (F.col("component") != F.col("group")) & (~F.col("is_large") | (F.col("component") > F.col("group")))
    outsiders = active.join(groups, "bucket").where(apart).select(F.col("group").alias("component"), "node").distinct()
    members = crowd.join(large, "component", "left_semi").select("component", "node")
    links = links.unionByName(links_to_groups(outsiders, members, own_sets, percent))

    others = active.where(~F.col("is_large")).select("bucket", "node", "n", "sketch", "component")
    rows = open_rows(others).select(*others.columns)
    left = stored(rows.select("node", "component").distinct(), "left-over")
    first = stored(rarest_elements(own_sets.join(left, "node", "left_semi"), percent), "rarest")
    lists = first.where("listed").groupBy("element").agg(F.count("*").alias("lists"))
    long = stored(lists.where(F.col("lists") > LONG_LIST).select("element"), "long-lists")
    pairs = pairs_by_elements(first.join(long, "element", "left_anti"), left, sketches, percent)
    roots = merged(roots, links.unionByName(tried.links(pairs)))
    if long.isEmpty():
        return roots

    # Only sets that have an element of a long list among their rarest can have links that are not found yet.
    late = first.join(long, "element", "left_semi").select("node").distinct()
    rows = stored(rows.join(late, "node", "left_semi").drop("component"), "in-long-lists")
    done = None
    for round_ in itertools.count():
        active = with_components(rows, roots)
        if done is not None:
            active = active.join(done, ["bucket", "node"], "left_anti")
        active = open_rows(active)
        if active.isEmpty():
            return roots
        # A small bucket is compared in full. In others each round has more leaders, which then have met all the rest.
        chosen = F.pmod(F.xxhash64("node", F.lit(round_)), F.col("held")) < min(4**round_ - 1, 1 << 62)
        leads = is_first | is_small | chosen
        roots = merged(roots, compared(active, leads, tried))
        led = active.where(leads).select("bucket", "node")
        done = stored(led if done is None else done.unionByName(led), "done")


def mark_near_copies(
    docs: DataFrame,
    percent: int = SIMILAR_PERCENT,
    shape: Bands = Bands(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two documents are linked if their sets of shingles share at least `percent` of their union; component_id is the
    smallest id that links lead to. Candidates come from shared bands; each link is confirmed on the full sets. Documents
    with equal sets are one node, so groups of copies cost no pairs. Null or blank texts have an empty set, are linked
    with nothing and kept. Rows that repeat an id belong to one node if their sets are equal, and are linked
    otherwise. Rows without an id are linked with nothing: component_id is null and they are kept. An empty table gives
    an empty result; other columns are not read.
    """
    signed = stored(signatures(docs, shape, id_column, text_column), "signatures")
    whole = signed.where("set_key is not null and doc_id is not null")
    classes = stored(whole.groupBy("set_key").agg(F.min("doc_id").alias("node")), "classes")
    nodes = whole.withColumnRenamed("doc_id", "node").join(classes, ["set_key", "node"], "left_semi")
    roots = linked(
        nodes.select("node", F.col("n_shingles").alias("n"), "bands"), docs, percent, id_column, text_column
    )
    if roots is not None:
        classes = classes.join(roots, "node", "left").select("set_key", F.coalesce("root", "node").alias("node"))
        classes = stored(classes, "rooted")
    members = signed.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id"))
    return members.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows that stay, with the input's columns: the document with the smallest id of each component."""
    marked = mark_near_copies(docs, id_column=id_column, text_column=text_column, **options)
    dropped = stored(marked.where("not kept").select(F.col("doc_id").alias("dropped_id")), "dropped")
    return docs.join(dropped, F.col(f"`{id_column}`") == F.col("dropped_id"), "left_anti")
