"""Secrets in every version of every text, found by scanning each different text once for each version of a rule.

A text's content address (SHA-256) is its blob. A ledger folder remembers which blobs have been scanned with which rule in which
version, and what was found in them. A run scans only the pairs that the ledger lacks, adds them to it, and joins the findings
of all blobs back to the rows that have them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherlake.llm.common import hot_keys, stored

# Unseen blobs up to this number are sent to all executors (32 bytes each), so that no seen text is looked at again.
FEW_BLOBS = 10_000


@dataclass(frozen=True)
class Rule:
    """A kind of secret: `pattern` as Python, Java and RE2 read it alike, and how long a match or one of its groups must be.

    `sign` is a quick test: a text without it has no match that counts. A changed rule needs a new version.
    """

    kind: str
    pattern: str
    sign: str
    least: int
    group: int = 0
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def either_case(pattern: str) -> str:
    """The pattern with each ASCII letter in both cases, and no other character that folds to it."""
    return re.sub("[a-z]", lambda letter: f"[{letter[0].upper()}{letter[0]}]", pattern)


_words = either_case("(password|passwd|secret|token|api_?key)")
_sets = r"""["']?\x20*[:=]"""
BASE = (
    Rule("assign", rf"""{_words}{_sets}\x20*["']?([A-Za-z0-9+/_.=-]+)""", rf"{_words}{_sets}", 8, group=2),
    Rule("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{12}", 16),
    Rule("hex", r"[0-9a-f]+", r"[0-9a-f]{32}", 32),
)
# Formats of keys that services give out, and the first line of a private key.
FORMATS = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", r"gh[oprsu]_[A-Za-z0-9]{36}", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", r"xox[abprs]-[A-Za-z0-9-]{10}", 15),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
)
RULES = BASE + FORMATS


def blob_of(text: Column) -> Column:
    """The content address of a text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def spans_of(text: str, rule: Rule) -> list[tuple[int, int]]:
    """The matches that count, leftmost and without overlap, as code points."""
    if not re.search(rule.sign, text):
        return []
    return [m.span() for m in re.finditer(rule.pattern, text) if len(m[rule.group]) >= rule.least]


class Ledger:
    """What has been scanned and found, one folder a run.

    A run writes its findings first and the pairs that it scanned last; only runs whose pairs are complete are read, so a run
    that broke off has not happened, and two runs at the same time at worst scan a pair twice.
    """

    SCANS = "blob BINARY, rules ARRAY<STRING>"
    FINDINGS = "blob BINARY, rule STRING, start INT, stop INT"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def runs(self) -> list[str]:
        """The complete runs' folders."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        system = path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = system.globStatus(path(f"{self.path}/run=*/scans/_SUCCESS")) or []
        return sorted(str(status.getPath().getParent().getParent()) for status in found)

    def _read(self, part: str, schema: str) -> DataFrame:
        runs = self.runs()
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{run}/{part}" for run in runs])

    def scanned(self) -> DataFrame:
        """blob, rules: the names of the rules that a blob was scanned with, once for each run that did."""
        return self._read("scans", self.SCANS)

    def findings(self) -> DataFrame:
        """blob, rule, start, stop."""
        return self._read("findings", self.FINDINGS)

    def add(self, scans: DataFrame, findings: DataFrame) -> None:
        run = f"{self.path}/run={uuid.uuid4().hex}"
        findings.write.parquet(f"{run}/findings")
        scans.write.parquet(f"{run}/scans")


def unseen(blobs: DataFrame, ledger: Ledger, rules: Sequence[Rule]) -> DataFrame:
    """blob, rules: for each blob the names of the rules that it has not been scanned with; only blobs that lack some."""
    known = ledger.scanned().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("known"))
    wanted = F.array(*[F.lit(rule.name) for rule in rules])
    lacking = F.when(F.col("known").isNull(), wanted).otherwise(F.array_except(wanted, F.col("known")))
    return blobs.join(known, "blob", "left").select("blob", lacking.alias("rules")).where(F.size("rules") > 0)


def _scan(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Findings of rows blob, text, rules."""
    by_name = {rule.name: rule for rule in rules}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (blob.as_py(), name, start, stop)
                for blob, text, names in zip(*batch.columns)
                for name in names.as_py()
                for start, stop in spans_of(text.as_py(), by_name[name])
            ]
            columns = list(zip(*found)) or [[]] * 4
            types = (pa.binary(), pa.string(), pa.int32(), pa.int32())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["blob", "rule", "start", "stop"])

    return texts.select("blob", "text", "rules").mapInArrow(run, Ledger.FINDINGS)


def scan_new(docs: DataFrame, blobs: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES, text_column: str = "text") -> int:
    """Scans the blobs of `docs` that the ledger lacks, adds them to it, and returns how many there were.

    `blobs` has the different blobs of the table. A text that is scanned is moved once, after the copies in a task
    have become one. If few blobs are new, their texts are picked out first; else texts without a sign of any rule
    are left out before any is moved.
    """
    new = stored(unseen(blobs, ledger, rules), "unseen-blobs")
    count = new.count()
    if not count:
        return 0
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    texts = docs.select(text.alias("text"))
    if count <= FEW_BLOBS:
        texts = texts.withColumn("blob", blob_of(F.col("text"))).join(F.broadcast(new.select("blob")), "blob", "left_semi")
    else:
        signs = "|".join(f"(?:{rule.sign})" for rule in rules)
        texts = texts.where(F.col("text").rlike(signs)).withColumn("blob", blob_of(F.col("text")))
    once = texts.groupBy("blob").agg(F.max("text").alias("text"))
    ledger.add(new, _scan(once.join(new, "blob"), rules))
    return count


def scan_versions(
    docs: DataFrame, ledger_path: str, rules: Sequence[Rule] = RULES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, blob (hex), n_<kind> for each rule, base_sha256, spans.

    `spans` has all findings as kind:start:end in code points, by start and then in the order of the rules, joined by commas;
    `base_sha256` is the digest of those of the rules in BASE. Null text counts as empty and has no findings. Rows that repeat give
    repeated results, an empty table an empty one; other columns are not read. The ledger at `ledger_path` must lie
    on a file system that all executors share; a second run over the same texts scans nothing.

    Rows meet findings by blob. A blob with more than a thousandth of all rows is dealt over several parts, and its
    findings, one row, are copied to them.
    """
    spark = docs.sparkSession
    rows = stored(docs.select(F.col(f"`{id_column}`").alias("doc_id"), blob_of(F.col(f"`{text_column}`")).alias("blob")), "blobs")
    copies = stored(rows.groupBy("blob").agg(F.count("*").alias("n")), "blob-copies")
    ledger = Ledger(spark, ledger_path)
    scan_new(docs, copies.select("blob"), ledger, rules, text_column)

    order = F.create_map(*[F.lit(x) for place, rule in enumerate(rules) for x in (rule.name, place)])
    kind = F.element_at(F.array(*[F.lit(rule.kind) for rule in rules]), F.col("place") + 1)
    found = ledger.findings().where(F.col("rule").isin([rule.name for rule in rules])).distinct().withColumn("place", order[F.col("rule")])
    found = found.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "place", "stop", kind.alias("kind")))).alias("found"))

    hot = F.broadcast(stored(hot_keys(copies, rows.count()), "hot-blobs"))
    parts = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.monotonically_increasing_id(), parts).cast("int")
    dealt = rows.join(hot, "blob", "left").select("doc_id", "blob", part.alias("part"))
    copied = found.join(hot, "blob", "left").select("blob", "found", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    joined = dealt.join(copied, ["blob", "part"], "left")

    def count(rule: Rule) -> Column:
        own = F.filter("found", lambda span: span["kind"] == rule.kind)
        return F.coalesce(F.size(own), F.lit(0)).cast("long").alias(f"n_{rule.kind}")

    def written(spans: Column) -> Column:
        texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))
        return F.coalesce(F.array_join(texts, ","), F.lit(""))

    base = F.filter("found", lambda span: span["kind"].isin([rule.kind for rule in BASE]))
    return joined.select(
        "doc_id",
        F.lower(F.hex("blob")).alias("blob"),
        *[count(rule) for rule in rules],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
    )
