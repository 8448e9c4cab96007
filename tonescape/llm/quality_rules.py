"""Quality rules on whole texts, and verdicts on hosts from their documents' failures.

Each document gets counts from its text and fails or passes four rules. Failures are
counted by host. A host with few documents says little, so its failure rate is shrunk to
the rate of all hosts with a beta prior whose two parameters come from all hosts
themselves (moments of the beta-binomial distribution, weighted by documents). A host is poor when its shrunk rate stays above a
limit, and the verdict goes back to its documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescape.llm import wordcode as wc
from tonescape.session import stage

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

#: Up to so many hosts (names of 64 bytes on average) every task gets all verdicts.
BROADCAST_HOSTS = 100_000

STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class QualityOptions:
    """Limits. A text fails with fewer words than ``min_words``, more than ``max_repeat`` of
    its words in repeated windows, more than ``max_symbols`` symbols a word, or more than
    ``max_dup_lines`` of its lines repeated. A host is poor when its shrunk failure rate is
    over ``max_host_rate``."""

    min_words: int = 50
    max_repeat: float = 0.5
    max_symbols: float = 0.1
    max_dup_lines: float = 0.3
    max_host_rate: float = 0.5


def _chunk_stats(chunk: wc.Chunk) -> dict[str, np.ndarray]:
    w = wc.words(chunk)
    data, rows = chunk.data, chunk.rows
    inside = ~wc.IS_SPACE[data]
    spans = wc.SpanHash(data)
    codes = spans.of(w.starts, w.ends)

    # lines: cut at every \n and at row bounds
    newline = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([chunk.bounds[:-1], newline + 1]))
    line_row = np.repeat(np.arange(rows), 1 + np.bincount(chunk.row_of(newline), minlength=rows))
    line_end = np.concatenate([line_start[1:] - 1, [len(data)]]) if len(line_start) else line_start
    last = np.append(line_row[1:] != line_row[:-1], True)
    line_end[last] = chunk.bounds[1:]
    full = np.searchsorted(w.starts, line_end) > np.searchsorted(w.starts, line_start)
    line_row = line_row[full]
    key = spans.of(line_start[full], line_end[full]) + wc.mix(line_row.astype(np.uint64) + np.uint64(1))
    _, first = np.unique(key, return_index=True)
    n_lines = np.bincount(line_row, minlength=rows)
    distinct = np.bincount(line_row[first], minlength=rows)

    # words in three-word windows that the row has twice or more
    at = wc.whole_windows(w.before, 3)
    repeated = np.zeros(len(codes) + 2, bool)
    if len(at):
        key = wc.ngram_hashes(codes, 3)[at] + wc.mix(w.row[at].astype(np.uint64) + np.uint64(1))
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = at[count[which] > 1]
        for k in range(3):
            repeated[twice + k] = True
    return {
        "n_words": np.diff(w.before),
        "word_chars": chunk.per_row(inside & ((data & 0xC0) != 0x80)),
        "n_symbols": chunk.per_row(_SYMBOL[data]),
        "n_lines": n_lines,
        "n_dup_lines": n_lines - distinct,
        "n_repeat_words": np.bincount(w.row[repeated[: len(codes)]], minlength=rows),
    }


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[str, list] = {name: [] for name in STATS}
        for chunk in wc.chunks(batch.column("text")):
            for name, values in _chunk_stats(chunk).items():
                found[name].append(values.astype(np.int64))
        columns = [batch.column("doc_id"), batch.column("host")]
        columns += [pa.array(np.concatenate(v) if v else np.empty(0, np.int64)) for v in found.values()]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "host", *STATS])


def text_stats(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the counts of each whole text. Narrow: no shuffle."""
    kept = docs.select("doc_id", F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), "text")
    kind = dict(kept.dtypes)["doc_id"]
    schema = f"doc_id {kind}, host string, " + ", ".join(f"{name} long" for name in STATS)
    return kept.mapInArrow(_stats, schema)


def with_rules(stats: DataFrame, options: QualityOptions) -> DataFrame:
    """One boolean per rule, ``base_failed`` and ``failed`` (any rule)."""
    too_short = F.col("n_words") < options.min_words
    repeats = F.col("n_repeat_words") > options.max_repeat * F.col("n_words")
    symbols = F.col("n_symbols") > options.max_symbols * F.col("n_words")
    lines = F.col("n_dup_lines") > options.max_dup_lines * F.col("n_lines")
    return stats.withColumns(
        {
            "base_failed": too_short | repeats,
            "symbols_failed": symbols,
            "lines_failed": lines,
            "failed": too_short | repeats | symbols | lines,
        }
    )


def beta_prior(rates: tuple[float | None, float | None]) -> tuple[float, float]:
    """Parameters of the beta distribution with this mean and variance of host rates.

    With no spread, or where nothing tells hosts apart, the prior is as strong as 1,000
    documents. Without hosts there is nothing to shrink, and the prior has no meaning.
    """
    mean, variance = rates
    if mean is None:
        return 0.5, 0.5
    strength = mean * (1 - mean) / variance - 1 if variance else 1000.0
    strength = min(max(strength, 0.0), 1000.0)
    return mean * strength, (1 - mean) * strength


def rate_moments(
    hosts: int, documents: int, failed: int, squares: float, scatter: float
) -> tuple[float | None, float | None]:
    """Mean of the hosts' rates and their variance without that of drawing the documents.

    ``squares``: sum of the hosts' squared document counts; ``scatter``: sum of their squared
    failures, each over its documents. Every host weighs as much as it has documents, so
    small ones count without a least size (Kleinman's moments with these weights). The
    variance is 0 where the rates differ by no more than chance, or cannot differ: with one
    host, or one document in each.
    """
    if not hosts:
        return None, None
    mean = failed / documents
    chance = mean * (1 - mean)
    spread = scatter - failed * mean - chance * (hosts - 1)
    weight = documents - squares / documents - (hosts - 1)
    if chance == 0 or weight <= 1e-9 * documents:
        return mean, 0.0
    return mean, min(max(spread / weight, 0.0), chance)


def host_verdicts(ruled: DataFrame, options: QualityOptions) -> DataFrame:
    """host, n_documents, n_failed, shrunk_rate, host_poor; one row per host."""
    hosts = ruled.groupBy("host").agg(
        F.count("*").alias("n_documents"), F.sum(F.col("failed").cast("long")).alias("n_failed")
    )
    documents, failed = F.col("n_documents").cast("double"), F.col("n_failed").cast("double")
    sums = hosts.agg(
        F.count("*"), F.sum("n_documents"), F.sum("n_failed"), F.sum(documents**2), F.sum(failed**2 / documents)
    ).first()
    alpha, beta = beta_prior(rate_moments(*sums))
    shrunk = (F.col("n_failed") + F.lit(alpha)) / (F.col("n_documents") + F.lit(alpha + beta))
    return hosts.withColumn("shrunk_rate", shrunk).withColumn(
        "host_poor", F.col("shrunk_rate") > options.max_host_rate
    )


def judge(docs: DataFrame, host: str = "source", options: QualityOptions = QualityOptions()) -> DataFrame:
    """Each row of ``docs`` with its counts, rules, its host's verdict and ``kept``.

    A document is kept if it passes every rule and its host is not poor. Null text: no
    words, so it fails. Null host: one host named ''. Repeated rows are judged each; ties
    do not arise. An empty table gives no rows. Other columns of ``docs`` are not read.
    The counts are stored once, so the texts are read once; only they are shuffled.
    """
    ruled = with_rules(stage(text_stats(docs, host), "quality"), options)
    verdicts = stage(host_verdicts(ruled, options), "hosts")
    few = verdicts.agg(F.count("*"), F.sum(F.octet_length("host"))).first()
    if few[0] <= BROADCAST_HOSTS and (few[1] or 0) <= 64 * BROADCAST_HOSTS:
        verdicts = F.broadcast(verdicts)  # else a host of many documents is split by the join
    joined = ruled.join(verdicts, "host", "left")
    return joined.withColumn("kept", ~F.col("failed") & ~F.col("host_poor"))
