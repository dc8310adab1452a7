"""Secret scans with an incremental ledger of blobs.

Every historical version of a file is addressed by the SHA-256 of its content,
its blob. The ledger holds, for each blob and each version of the rules, the
findings of the one scan that was made of it. A run scans only the pairs that
the ledger lacks, adds them, and joins the findings back to all paths.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.chunks import sliced
from freshet.session import shared_path

RULES_VERSION = "1"
# Kind, pattern, the group that must have a least length, that length.
RULES = (
    (
        "assign",
        re.compile(r"""(?a:((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""),
        2,
        6,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
# Texts without any of these have no finding.
NEEDED = r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
HITS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))
SEEN = 500_000  # blobs that a task remembers while it drops copies
OUT_BYTES = 8 << 20


def findings(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of all secrets of a text, by start, then kind as listed."""
    found = []
    for order, (kind, pattern, group, least) in enumerate(RULES):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), order, kind, m.end()))
    return [(kind, start, stop) for start, _, kind, stop in sorted(found)]


def first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops rows whose blob the task has met, so a hot blob is shuffled once per task."""
    seen: set = set()
    for batch in batches:
        keep = []
        for blob in batch.column(0).to_pylist():
            if len(seen) >= SEEN:
                seen.clear()
            keep.append(blob not in seen)
            seen.add(blob)
        yield batch.filter(pa.array(keep))


def scan_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set = set()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
    for batch in batches:
        suspect = pc.match_substring_regex(batch.column(1), NEEDED).to_pylist()
        names, hits = [], []
        for row, (blob, look) in enumerate(zip(batch.column(0).to_pylist(), suspect, strict=True)):
            if blob in seen:
                continue
            seen.add(blob)
            found = findings(batch.column(1)[row].as_py()) if look else []
            names.append(blob)
            hits.append([{"kind": k, "start": a, "stop": b} for k, a, b in found])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(hits, kind)], names=["blob", "hits"])


def ledger_of(spark: SparkSession, ledger: str, rules_version: str) -> DataFrame | None:
    """Blobs that were scanned under these rules, or None before the first run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.parquet(ledger).filter(F.col("rules_version") == rules_version).drop("rules_version")


def scan_new(versions: DataFrame, ledger: str, content: str = "text", rules_version: str = RULES_VERSION) -> DataFrame:
    """Scans the blobs the ledger lacks, adds them to it, and returns the scanned ledger.

    The text moves once, to the task that owns its blob; copies within a task
    are dropped before. A run that is cut off adds nothing, so it can be
    repeated. One run at a time writes to a ledger.
    """
    spark = versions.sparkSession
    text = F.coalesce(F.col(content).cast("string"), F.lit(""))
    blobs = versions.select(F.sha2(text.cast("binary"), 256).alias("blob"), text.alias("content"))
    known = ledger_of(spark, ledger, rules_version)
    fresh = blobs if known is None else blobs.join(known.select("blob"), "blob", "left_anti")
    once = fresh.mapInArrow(first_seen, fresh.schema).repartition("blob")
    schema = T.StructType([T.StructField("blob", T.StringType()), T.StructField("hits", HITS)])
    scanned = once.mapInArrow(scan_blobs, schema).withColumn("rules_version", F.lit(rules_version))
    scanned.write.mode("append").parquet(ledger)
    return ledger_of(spark, ledger, rules_version)


def scan(
    versions: DataFrame,
    ledger: str | None = None,
    content: str = "text",
    rules_version: str = RULES_VERSION,
    blob: str = "blob",
    hits: str = "hits",
) -> DataFrame:
    """All rows of ``versions`` with their blob and ``hits``, the findings in their content.

    ``hits`` lists kind, start and stop in code points, by start and then by the
    order of the rules. Without ``ledger`` a new one is made in the shared folder.
    Columns with the names of the results are replaced. A null content is empty
    and has no findings; repeated rows keep their rows; keys may be null.
    """
    ledger = ledger or shared_path(versions.sparkSession, "ledger")
    scanned = scan_new(versions, ledger, content, rules_version).select(F.col("blob").alias(blob), F.col("hits").alias(hits))
    text = F.coalesce(F.col(content).cast("string"), F.lit(""))
    paths = versions.withColumn(blob, F.sha2(text.cast("binary"), 256)).drop(hits)
    return paths.join(scanned, blob, "left").select(*paths.columns, hits)


def redact(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """The text with each span, or run of overlapping spans, replaced by the mark."""
    out, at, end = [], 0, -1
    for start, stop in sorted(spans):
        if start >= end:
            if end >= 0:
                out.append(mark)
                at = end
            out.append(text[at:start])
            end = stop
        else:
            end = max(end, stop)
    if end < 0:
        return text
    return "".join([*out, mark, text[end:]])


def redacted(found: DataFrame, content: str = "text", mark: str = "[SECRET]", hits: str = "hits") -> DataFrame:
    """The rows of ``scan`` with their secrets replaced by the mark, without ``hits``."""
    at, place = found.columns.index(content), found.columns.index(hits)
    kept = found.drop(hits)
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(at), batch.column(place).to_pylist(), strict=True)
            texts = (redact(t.as_py(), [(h["start"], h["stop"]) for h in spans], mark) if spans else t.as_py() for t, spans in rows)
            begin = 0
            for part in sliced(texts, lambda t: len(t or ""), OUT_BYTES):
                columns = [c.slice(begin, len(part)) for c in batch.columns]
                columns[at] = pa.array(part, pa.string())
                begin += len(part)
                del columns[place]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return found.mapInArrow(run, kept.schema)
