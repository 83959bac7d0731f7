"""Operator 10: secret scans through a ledger of content-addressed blobs.

Every version of every document is addressed by the SHA-256 of its text. A blob is scanned once for
each version of the rules; the ledger (a Parquet table, in a folder for each version of the rules)
keeps what was found, nothing included, and
findings are joined back to all documents, or paths, that hold the blob.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import shared_path

from .shared import batch, landed, longs, over_batches, table, texts_of

RULE_VERSION = "3"

# The base rules, their least lengths, and the order of kinds at one place.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_VALUE, ACCESS_CHARS = 12, 18
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
BASE_KINDS = ["assign", "access", "hex"]
# Further kinds that one pattern finds, and a string that each match holds.
FURTHER = [
    ("github", "gh", re.compile(r"\bgh[opsur]_[A-Za-z0-9]{36,}")),
    ("slack", "xox", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}")),
    ("google", "AIza", re.compile(r"\bAIza[A-Za-z0-9_-]{35}")),
]
# The marks of private keys, and the parts of signed tokens with their least lengths.
PEM_HEAD, PEM_END = (re.compile(rf"-----{x} (?:[A-Z0-9]+ )*PRIVATE KEY-----") for x in ("BEGIN", "END"))
JWT_RUN, JWT_START, JWT_CHARS, JWT_LAST = re.compile(r"[A-Za-z0-9_-]+"), re.compile(r"\beyJ"), 11, 8
KINDS = [*BASE_KINDS, "pem", "jwt", *(kind for kind, _, _ in FURTHER)]

ORDER = {kind: k for k, kind in enumerate(KINDS)}
KEYWORDS = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)


def pem_spans(text: str) -> Iterator[tuple[int, int]]:
    """Private keys from head to end mark, a head alone where no end follows; every mark is looked at once."""
    ends = [m.span() for m in PEM_END.finditer(text)]
    at = k = 0
    for head in PEM_HEAD.finditer(text):
        if head.start() < at:
            continue
        while k < len(ends) and ends[k][0] < head.end():
            k += 1
        at = ends[k][1] if k < len(ends) else head.end()
        yield head.start(), at


def jwt_spans(text: str) -> Iterator[tuple[int, int]]:
    """Three runs of token characters with a point between each two, the first two being JSON in base 64."""
    held: list[tuple[int, int]] = []
    for run in JWT_RUN.finditer(text):
        a, b = run.span()
        if held and not (a == held[-1][1] + 1 and text[a - 1] == "."):
            held = []
        if len(held) == 2 and b - a >= JWT_LAST:
            yield held[0][0], b
            held = []
            continue
        if len(held) == 1 and text.startswith("eyJ", a) and b - a >= JWT_CHARS:
            held.append((a, b))
            continue
        start = JWT_START.search(text, a, b)
        held = [(start.start(), b)] if start and b - start.start() >= JWT_CHARS else []


def spans_of(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all findings in code points, by start and then kind."""
    found: list[tuple[int, int, str]] = []
    if KEYWORDS.search(text):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    # A run of 16 or more is what a run of one or more leaves once shorter ones are dropped.
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        found += [(a, b, "pem") for a, b in pem_spans(text)]
    if "eyJ" in text:
        found += [(a, b, "jwt") for a, b in jwt_spans(text)]
    for kind, needle, pattern in FURTHER:
        if needle in text:
            found += [(*m.span(), kind) for m in pattern.finditer(text)]
    return sorted(found, key=lambda x: (x[0], ORDER[x[2]], x[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


FINDINGS = "blob binary, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _scan(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for record in records:
        counts: dict[str, list[int]] = {kind: [] for kind in BASE_KINDS}
        digests, spans = [], []
        for text in texts_of(record):
            found = spans_of(text)
            base = [x for x in found if x[2] in counts]
            for kind in BASE_KINDS:
                counts[kind].append(sum(x[2] == kind for x in base))
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append(joined(found))
        yield batch(
            blob=record.column("blob").cast(pa.binary()), n_assign=longs(counts["assign"]), n_access=longs(counts["access"]), n_hex=longs(counts["hex"]),
            base_sha256=pa.array(digests, pa.string()), spans=pa.array(spans, pa.string()),
        )


def scan(docs: DataFrame, ledger: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """Findings of every row of ``docs`` (doc_id, text); unseen blobs are scanned and added to ``ledger``.

    Null texts are empty blobs. Rows with one doc_id are versions of it and all come back, rows
    alike each for itself. Texts are scanned whole, in time that follows their length. The ledger
    may be absent yet, and a scan may add to it while another does: a blob that both have added
    counts once. Extra columns of ``docs`` are left out; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    paths = landed(rows.select("doc_id", "blob"), "paths")
    # One holder for each blob: the dearest step, the scan, then sees each text once, and a blob
    # that a third of all rows hold is no skewed key.
    blobs = paths.groupBy("blob").agg(F.min("doc_id").alias("holder"))
    holders = blobs
    if (seen := read_ledger(spark, ledger, rule_version)) is not None:
        blobs = landed(blobs, "blobs")
        holders = blobs.join(seen.select("blob"), "blob", "left_anti")
    texts = rows.join(
        holders.withColumnRenamed("blob", "wanted"), F.col("doc_id").eqNullSafe(F.col("holder")) & (F.col("blob") == F.col("wanted"))
    ).select("blob", "text")
    found = over_batches(texts, _scan, FINDINGS)
    found.withColumn("rule_version", F.lit(rule_version)).write.mode("append").partitionBy("rule_version").parquet(ledger)
    known = read_ledger(spark, ledger, rule_version).drop("rule_version")
    if seen is not None:  # of a ledger with a history, what these rows ask for is all that is copied
        known = known.join(blobs.select("blob"), "blob", "left_semi")
    # Each blob once, landed: rows alike and scans at the same time give it twice, and the join has
    # exchanges of its own, so that Spark can split a blob that very many rows hold.
    known = landed(known.dropDuplicates(["blob"]), "known-blobs")
    return paths.join(known, "blob")


def read_ledger(spark: SparkSession, ledger: str, rule_version: str) -> DataFrame | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    seen = spark.read.schema(f"{FINDINGS}, rule_version string").parquet(ledger)
    return seen.where(F.col("rule_version") == rule_version)


def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), shared_path(spark, "secret-ledger")).drop("blob")
