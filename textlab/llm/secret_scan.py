"""Secret scan with an incremental ledger of blobs.

A text is a blob, known by the SHA-256 of its bytes. The ledger is a folder of Parquet files with one row for each pair of
blob and rule version that was scanned, clean blobs included, and its findings. A run scans a blob once, and only
if the ledger lacks the pair; then the findings of all versions of all paths come from the ledger by a join. A new
rule version scans everything again under its own name; old rows stay.

Spans are in code points, end exclusive, leftmost and not overlapping within a kind. Null texts count as
empty, which is a blob without findings. Rows given twice get the findings twice. Equal texts, however many, are one
row of the scan; the joins on blobs leave skew to the adaptive join, and carry digests and spans but no texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from textlab.llm.workers import ship, slices

RULE_VERSION = "6"
FINDINGS = "array<struct<kind:string,start:bigint,end:bigint>>"

# A private key goes from its header to the END line of the same words, unless another block begins or ends before. Without that line it
# goes over armor headers (`Name: value`) and base64 lines, the last perhaps short, and a checksum; line ends may be escaped.
_LINE_END = r"[ \t]*(?:\r?\n|\r|(?:\\[rn])+)[ \t]*"
_PRIVATE_KEY = (
    r"-----BEGIN (?P<words>(?:[A-Z0-9]+ ){0,3}PRIVATE KEY(?: BLOCK)?)-----"
    r"(?:[^-]*(?:-(?!----(?:BEGIN|END) )[^-]*)*-----END (?P=words)-----"
    rf"|(?:{_LINE_END}[A-Z][A-Za-z-]*:[ ][^\r\n\\]*)*(?:(?:(?:\s|\\[rn])+[A-Za-z0-9+/=]{{16,}})+"
    rf"(?:{_LINE_END}[A-Za-z0-9+/]{{1,15}}={{0,2}}(?=[ \t]*(?:[\r\n\\]|\Z)))?(?:{_LINE_END}=[A-Za-z0-9+/]{{4}})?)?)"
)

# The kinds in the order in which spans of the same start are listed, and their patterns.
# The first three are the base kinds; `least` is the length that the group needs.
RULES = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("private_key", _PRIVATE_KEY, 0, 1),
    ("github", r"gh[oprsu]_[A-Za-z0-9]{36,}", 0, 1),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]+", 0, 1),
    ("url_login", r"[a-z][a-z0-9+]{1,15}://[^\s/:@]+:[^\s/:@]+@", 0, 1),
]
BASE_KINDS = ("assign", "access", "hex")
_COMPILED = [(kind, re.compile(pattern), group, least) for kind, pattern, group, least in RULES]
# What a text must match for a rule to be tried on it; a quick test of whole batches.
_HINTS = {
    "assign": "(?i)(password|passwd|secret|token|api_?key)",
    "access": "AKIA",
    "hex": "[0-9a-f]{24}",
    "private_key": "-----BEGIN ",
    "github": "gh[oprsu]_",
    "slack": "xox[abprs]-",
    "jwt": "eyJ",
    "url_login": "://",
}


def find_secrets(texts: pa.Array) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) in each text, by start, then by kind as listed."""
    found: dict[int, list] = {}
    for order, (kind, pattern, group, least) in enumerate(_COMPILED):
        rows = np.flatnonzero(pc.match_substring_regex(texts, _HINTS[kind]).to_numpy(zero_copy_only=False))
        for row in rows.tolist():
            for match in pattern.finditer(texts[row].as_py()):
                if match.end(group) - match.start(group) >= least:
                    found.setdefault(row, []).append((match.start(), order, kind, match.end()))
    return [[(kind, start, end) for start, _, kind, end in sorted(found.get(row, []))] for row in range(len(texts))]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in find_secrets(pc.fill_null(batch.column("text"), ""))]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(found, kind)], ["blob", "findings"])


def blob(text: str = "text"):
    return F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256))


def read_ledger(spark, folder: str) -> DataFrame:
    """All scanned pairs, each once, even if two runs have scanned it at the same time; empty if there is no ledger yet."""
    schema = f"blob binary, rule_version string, findings {FINDINGS}"
    try:
        rows = spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return rows.groupBy("blob", "rule_version").agg(F.first("findings").alias("findings"))


def scan_new(documents: DataFrame, folder: str, text: str = "text", rule_version: str = RULE_VERSION) -> None:
    """Scan the blobs that the ledger lacks under this rule version and append them.

    The scan itself may be repeated by Spark for a lost executor; the ledger gets each pair once, when it is written.
    """
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select(blob(text).alias("blob"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    seen = read_ledger(spark, folder).filter(F.col("rule_version") == rule_version).select("blob")
    unseen = rows.join(seen, "blob", "left_anti") if not seen.isEmpty() else rows
    one_each = unseen.dropDuplicates(["blob"])
    one_each.mapInArrow(_scan, f"blob binary, findings {FINDINGS}").select("blob", F.lit(rule_version).alias("rule_version"), "findings").write.mode("append").parquet(folder)


def findings_by_path(documents: DataFrame, folder: str, key: str = "doc_id", text: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """`(key, findings)` of every row, from the ledger."""
    ledger = read_ledger(documents.sparkSession, folder).filter(F.col("rule_version") == rule_version).select("blob", "findings")
    return documents.select(F.col(f"`{key}`"), blob(text).alias("blob")).join(ledger, "blob").select(key, "findings")


def redact(texts: DataFrame, keep, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """Rows with `findings`, the spans replaced by a mark; overlapping spans become one."""
    ship(texts.sparkSession)
    others = [c for c in keep if c != text]
    source = texts.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)], "findings", F.col(f"`{text}`").alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("findings").to_pylist()):
                parts, at = [], 0
                for span in sorted(spans or [], key=lambda s: s["start"]):
                    if span["start"] >= at:
                        parts += [text[at : span["start"]], mark]
                    at = max(at, span["end"])
                out.append("".join([*parts, text[at:]]) if spans else text)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(out, pa.string())], [*batch.schema.names[:-2], "text"])

    schema = ", ".join([*[f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(source.schema.fields[:-2])], "text string"])
    names = {c: F.col(f"_{i}").alias(c) for i, c in enumerate(others)} | {text: F.col("text").alias(text)}
    return source.mapInArrow(apply, schema).select(*[names[c] for c in keep])
