"""Credentials in texts, told apart by how many owners show the same one.

Patterns find candidates in whole texts. Each candidate's value is hashed, and the hashes
are counted over the whole corpus: in how many repositories (documents, exact copies of a
text counted once) and by how many owners (sources) does the same value stand? A value that
several owners or many repositories show is a widely copied example; one that stays with
its owner, in few repositories, looks live.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescape.session import stage

# The patterns of the three base kinds, and public credential formats.
_NAMES = r"(password|passwd|secret|token|api_?key)"
_ASSIGN = re.compile(_NAMES + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_VENDOR = re.compile(
    r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}"
)
_BEARER = re.compile(r"[Bb]earer\x20+([A-Za-z0-9._~+/-]{20,}=*)")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----")

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "vendor", "bearer", "pem")

_SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value_hash", pa.binary())]
)
_SPANS_SQL = "array<struct<kind:string,start:long,end:long,value_hash:binary>>"


@dataclass(frozen=True)
class SecretOptions:
    """A value shown by ``example_owners`` owners or more is an example, and so is one that
    ``example_repositories`` different texts or more show, whoever owns them."""

    example_owners: int = 3
    example_repositories: int = 10


def find_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind's place in KINDS, value) of every candidate, by start, then kind."""
    found = []
    lower = text.lower()
    if any(hint in lower for hint in _ASSIGN_HINTS):
        found += [(m.start(), m.end(), 0, m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1, m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), m.end(), 2, m[0]) for m in _HEX.finditer(text)]
    found += [(m.start(), m.end(), 3, m[0]) for m in _VENDOR.finditer(text)]
    if "earer" in text:
        found += [(m.start(), m.end(), 4, m[1]) for m in _BEARER.finditer(text)]
    if "PRIVATE KEY-----" in text:
        found += [(m.start(), m.end(), 5, m[0]) for m in _PEM.finditer(text)]
    return sorted(found)


def join_spans(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k, _ in spans)


def _scan(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {kind: [] for kind in BASE}
        digests, joined, spans = [], [], []
        for text in batch.column("text"):
            own = find_spans(text.as_py() or "")
            base = [s for s in own if s[2] < len(BASE)]
            for place, kind in enumerate(BASE):
                counts[kind].append(sum(s[2] == place for s in base))
            digests.append(hashlib.sha256(join_spans(base).encode()).hexdigest())
            joined.append(join_spans(own))
            spans.append(
                [
                    {"kind": KINDS[k], "start": a, "end": b, "value_hash": hashlib.sha256(v.encode()).digest()[:16]}
                    for a, b, k, v in own
                ]
            )
        columns = [batch.column(name) for name in keep]
        columns += [pa.array(counts[kind], pa.int64()) for kind in BASE]
        columns += [pa.array(digests), pa.array(joined, pa.string()), pa.array(spans, pa.list_(_SPAN))]
        names = [*keep, *(f"n_{kind}" for kind in BASE), "base_sha256", "spans", "found"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def candidates(docs: DataFrame, owner: str = "source") -> DataFrame:
    """doc_id, owner, text_hash, counts per base kind, digest and list of spans. Narrow, texts read once."""
    kept = docs.select("doc_id", F.col(owner).cast("string").alias("owner"), F.xxhash64("text").alias("text_hash"), "text")
    kind = dict(kept.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, owner string, text_hash long, n_assign long, n_access long, n_hex long, "
        f"base_sha256 string, spans string, found {_SPANS_SQL}"
    )
    return kept.mapInArrow(lambda it: _scan(it, ["doc_id", "owner", "text_hash"]), schema)


def ownership(found: DataFrame, options: SecretOptions = SecretOptions()) -> DataFrame:
    """value_hash, n_repositories, n_owners, verdict, from rows with text_hash, owner, found.

    Spark counts distinct texts and owners in steps, first per value and text or owner, so
    that no task sees more of a value that stands everywhere than one row per task before.
    """
    each = found.select("text_hash", F.struct("owner").alias("owner"), F.explode("found.value_hash").alias("value_hash"))
    counted = each.groupBy("value_hash").agg(
        F.count_distinct("text_hash").alias("n_repositories"), F.count_distinct("owner").alias("n_owners")
    )
    shared = (F.col("n_owners") >= options.example_owners) | (F.col("n_repositories") >= options.example_repositories)
    return counted.withColumn("verdict", F.when(shared, "example").otherwise("live"))


def judged_spans(found: DataFrame, options: SecretOptions = SecretOptions()) -> DataFrame:
    """row_id and, for rows with candidates, their list of (start, end, kind, n_repositories, n_owners, verdict)."""
    verdicts = ownership(found, options)
    each = found.select("row_id", F.explode("found").alias("span"))
    each = each.select("row_id", "span.*")
    joined = each.join(verdicts, "value_hash", "left")
    entry = F.struct("start", "end", "kind", "n_repositories", "n_owners", "verdict")
    return joined.groupBy("row_id").agg(F.sort_array(F.collect_list(entry)).alias("judged"))


def scan(docs: DataFrame, owner: str = "source", options: SecretOptions = SecretOptions()) -> DataFrame:
    """Each row of ``docs``: its candidates and how the corpus judges them.

    Columns: doc_id, owner, n_assign, n_access, n_hex, base_sha256, spans, found, judged
    (list of start, end, kind, n_repositories, n_owners, verdict), n_live, n_example. Offsets are code
    points, ends exclusive. Null text: empty. Null owner: an owner like any other. A
    repeated row gives a repeated result; its values count once per different text. No candidates:
    zeros and an empty list. Other columns of ``docs`` are not read. What the texts gave is
    stored once; the two shuffles carry hashes and offsets, not texts.
    """
    found = stage(candidates(docs, owner).withColumn("row_id", F.monotonically_increasing_id()), "secrets")
    judged = found.drop("found").join(judged_spans(found, options), "row_id", "left")
    judged = judged.withColumn("judged", F.coalesce("judged", F.array().cast(dict(judged.dtypes)["judged"])))
    return judged.withColumns({f"n_{v}": _count(F.col("judged"), v) for v in ("live", "example")}).drop("row_id", "text_hash")


def _count(spans: Column, verdict: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["verdict"] == verdict)).cast("long")


REDACTED = "[REDACTED]"

#: Column of the spans to replace, after all columns of the table: it is found by its place.
_LIVE = "__live"


def redact_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with each maximal covered span replaced."""
    parts, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            parts += [text[at:start], REDACTED]
        at = max(at, end)
    return "".join(parts) + text[at:]


def _redact(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            texts.append(text if text is None else redact_text(text, [(s["start"], s["end"]) for s in spans or ()]))
        columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(i) for i, n in enumerate(names)]
        if "n_chars" in names and pa.types.is_integer(batch.schema.field("n_chars").type):
            kind = batch.schema.field("n_chars").type
            sizes = [None if t is None else len(t) for t in texts]
            columns[names.index("n_chars")] = pa.array(sizes, kind)
        yield pa.RecordBatch.from_arrays(columns, names=names)


def redact(docs: DataFrame, owner: str = "source", options: SecretOptions = SecretOptions()) -> DataFrame:
    """``docs``, all rows and columns, with live-looking credentials replaced in the text.

    Examples stay. A column n_chars of whole numbers follows the text. Only texts with
    candidates meet the corpus's verdicts; all others pass through without a shuffle. Null and
    empty texts stay as they are, repeated rows are all redacted, an empty table stays empty,
    and other columns, of whatever names, pass through.
    """
    inner = {name: name if name == "text" else f"c{i}" for i, name in enumerate(docs.columns)}
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc")
    keys = [doc, F.xxhash64("text").alias("text_hash"), F.col(owner).cast("string").alias("owner")]
    rows = docs.select(*(F.col(name).alias(other) for name, other in inner.items()), *keys)
    keep = rows.columns
    counts = ", ".join(f"n_{kind} long" for kind in BASE)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    scanned = rows.mapInArrow(
        lambda it: _scan(it, keep), f"{schema}, {counts}, base_sha256 string, spans string, found {_SPANS_SQL}"
    )
    # the texts are scanned once, and stored with what they hold
    marked = stage(scanned.select(*keep, "found", (F.size("found") > 0).alias("hit")), "secrets")
    found = marked.where("hit").select("doc", "text_hash", "owner", "found")
    verdicts = ownership(found, options).where("verdict = 'live'").select("value_hash")
    each = found.select("doc", "text_hash", F.explode("found").alias("span")).select("doc", "text_hash", "span.*")
    live = each.join(verdicts, "value_hash", "left_semi").groupBy("doc", "text_hash")
    live = live.agg(F.collect_set(F.struct("start", "end")).alias("live"))
    back = [F.col(other).alias(name) for name, other in inner.items()]
    hit = marked.where("hit").join(live, ["doc", "text_hash"], "left").select(*back, F.col("live").alias(_LIVE))
    names = docs.columns
    changed = hit.mapInArrow(lambda it: _redact(it, names), docs.schema)
    return marked.where("not hit").select(*back).unionByName(changed)
