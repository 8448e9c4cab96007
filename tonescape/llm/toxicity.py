"""Toxicity of whole texts from a small recurrent network.

A word's input is the mean of the vectors of its character n-grams beside its own vector
(both in hashed tables). Windows of words run through a gated recurrent network in both
directions; attention weighs the states, and their mean gives the window's logit. All
windows of a text are scored, each overlapping the next, and the text's score is its
highest window's, calibrated on whole training texts.

The network is trained in numpy from a bounded sample of labelled rows. Labels hold for
texts, not windows: a toxic text teaches through the window that looks worst at the time,
a clean one through windows at random and its worst.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescape.llm import wordcode as wc

_F = np.float32

# Byte classes: letters in lower case, other ASCII marks dropped, UTF-8 sequences kept.
_FOLD = np.zeros(256, np.uint8)
_FOLD[ord("0") : ord("9") + 1] = range(ord("0"), ord("9") + 1)
_FOLD[ord("a") : ord("z") + 1] = range(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = range(ord("a"), ord("z") + 1)
_FOLD[128:] = range(128, 256)


@dataclass(frozen=True)
class ToxicOptions:
    """``sample``: labelled texts of each class to learn from, at most. ``window`` words are
    read at a time, one every ``stride``. ``width``: states per direction; ``embed``: size
    of either vector of a word; ``table``: rows of the hashed tables."""

    sample: int = 1200
    window: int = 64
    stride: int = 48
    width: int = 8
    embed: int = 8
    table: int = 1 << 17
    epochs: int = 4
    batch: int = 256
    rate: float = 0.08
    threshold: float = 0.3
    seed: int = 11


@dataclass
class Network:
    """All weights, by name; ``scale`` and ``shift`` turn the worst logit into a score."""

    options: ToxicOptions
    weights: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    _squares: dict[str, np.ndarray] = field(default_factory=dict, repr=False)


def new_network(o: ToxicOptions) -> Network:
    rng = np.random.default_rng(o.seed)
    h, e = o.width, o.embed

    def draw(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(_F)

    return Network(
        o,
        {
            "chars": draw(o.table, e, scale=0.02),
            "words": draw(o.table, e, scale=0.02),
            "input": draw(2, 2 * e, 3 * h, scale=0.4),
            "bias": np.zeros((2, 1, 3 * h), _F),
            "gates": draw(2, h, 2 * h, scale=0.2),
            "state": draw(2, h, h, scale=0.2),
            "attend": draw(2 * h, scale=0.2),
            "out": draw(2 * h, scale=0.4),
            "out_bias": np.zeros(1, _F),
        },
    )


# --- Words ------------------------------------------------------------------------------


@dataclass
class WordFeatures:
    """Of distinct words: their row in the word table, and n-gram rows, ``bounds`` by word."""

    word: np.ndarray
    grams: np.ndarray
    bounds: np.ndarray


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: int) -> WordFeatures:
    """Features of the words at the spans; marks within or around a word do not count."""
    n = len(starts)
    sizes = ends - starts
    index = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    folded = _FOLD[data[index]]
    keep = folded > 0
    owner = np.repeat(np.arange(n), sizes)[keep]
    sizes = np.bincount(owner, minlength=n) + 2  # with an edge mark on both sides
    bounds = np.append(0, np.cumsum(sizes))
    body = np.full(bounds[-1], 1, np.uint8)
    inner = np.ones(bounds[-1], bool)
    inner[bounds[:-1]] = inner[bounds[1:] - 1] = False
    body[inner] = folded[keep]
    spans = wc.SpanHash(body)
    word = (spans.of(bounds[:-1], bounds[1:]) % np.uint64(table)).astype(np.int32)
    owner = np.repeat(np.arange(n), sizes)
    grams, owners = [], []
    for size in (3, 4, 5):
        at = np.flatnonzero(np.arange(bounds[-1]) + size <= bounds[1:][owner])
        grams.append((spans.of(at, at + size) % np.uint64(table)).astype(np.int32))
        owners.append(owner[at])
    owners, grams = np.concatenate(owners), np.concatenate(grams)
    order = np.argsort(owners, kind="stable")
    return WordFeatures(word, grams[order], np.append(0, np.cumsum(np.bincount(owners, minlength=n))))


def vectors(net: Network, f: WordFeatures) -> np.ndarray:
    """One vector per distinct word, and one of zeros at the end for no word."""
    e = net.options.embed
    out = np.zeros((len(f.word) + 1, 2 * e), _F)
    has = np.flatnonzero(np.diff(f.bounds))
    if len(has):
        sums = np.add.reduceat(net.weights["chars"][f.grams], f.bounds[:-1][has], axis=0)
        out[has, :e] = sums / np.diff(f.bounds)[has, None]
    out[:-1, e:] = net.weights["words"][f.word]
    return out


# --- Network ------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def forward(net: Network, projected: np.ndarray, index: np.ndarray, keep: bool = False):
    """Logits of windows. ``projected`` (2, words + 1, 3 * width): inputs of either direction;
    ``index`` (windows, steps): word of each step, the last row standing for none."""
    w, h = net.weights, net.options.width
    n, steps = index.shape
    none = projected.shape[1] - 1
    both = np.stack([index, index[:, ::-1]])  # direction, window, step
    mask = (both != none)[..., None].astype(_F)
    state = np.zeros((2, n, h), _F)
    states = np.empty((steps, 2, n, h), _F)
    trace = []
    for t in range(steps):
        x = np.stack([projected[0][both[0, :, t]], projected[1][both[1, :, t]]])
        gates = _sigmoid(x[..., : 2 * h] + state @ w["gates"])
        z, r = gates[..., :h], gates[..., h:]
        inner = state @ w["state"]
        new = np.tanh(x[..., 2 * h :] + r * inner)
        m = mask[:, :, t]
        if keep:
            trace.append((state, z, r, inner, new))
        state = state + m * (1 - z) * (new - state)
        states[t] = state
    joined = np.concatenate([states[:, 0], states[::-1, 1]], axis=-1)  # step, window, 2 * width
    score = joined @ w["attend"]
    score[index.T == none] = -1e9
    score = np.exp(score - score.max(0))
    share = score / score.sum(0)
    pooled = np.einsum("tn,tnk->nk", share, joined)
    logits = pooled @ w["out"] + w["out_bias"]
    return (logits, (both, mask, trace, joined, share, pooled)) if keep else logits


def backward(net: Network, cache, d_logits: np.ndarray, words: int):
    """Gradients of the weights and of ``projected``."""
    w, h = net.weights, net.options.width
    both, mask, trace, joined, share, pooled = cache
    grad = {"out": pooled.T @ d_logits, "out_bias": d_logits.sum(keepdims=True)}
    d_pooled = d_logits[:, None] * w["out"]
    value = np.einsum("tnk,nk->tn", joined, d_pooled)
    d_score = share * (value - (share * value).sum(0))
    grad["attend"] = np.einsum("tn,tnk->k", d_score, joined)
    d_joined = share[..., None] * d_pooled + d_score[..., None] * w["attend"]
    steps = len(trace)
    d_states = np.stack([d_joined[..., :h], d_joined[::-1, :, h:]], axis=1)
    grad["gates"], grad["state"] = np.zeros_like(w["gates"]), np.zeros_like(w["state"])
    d_projected = np.zeros((2, words, 3 * h), _F)
    carry = np.zeros_like(d_states[0])
    for t in reversed(range(steps)):
        state, z, r, inner, new = trace[t]
        d = d_states[t] + carry
        dm = d * mask[:, :, t]
        d_new = dm * (1 - z) * (1 - new * new)
        d_z = dm * (state - new) * z * (1 - z)
        d_r = d_new * inner * r * (1 - r)
        d_inner = d_new * r
        d_gates = np.concatenate([d_z, d_r], -1)
        flipped = state.transpose(0, 2, 1)
        grad["gates"] += flipped @ d_gates
        grad["state"] += flipped @ d_inner
        d_x = np.concatenate([d_gates, d_new], -1)
        for side in range(2):
            np.add.at(d_projected[side], both[side, :, t], d_x[side])
        carry = d - dm * (1 - z)
        carry += d_gates @ w["gates"].transpose(0, 2, 1) + d_inner @ w["state"].transpose(0, 2, 1)
    d_projected[:, -1] = 0
    return grad, d_projected


def project(net: Network, vector: np.ndarray) -> np.ndarray:
    return vector @ net.weights["input"] + net.weights["bias"]


# --- Texts ------------------------------------------------------------------------------


@dataclass
class Texts:
    """Distinct words of some texts, and the windows over them: word indices and row."""

    features: WordFeatures
    index: np.ndarray
    row: np.ndarray
    rows: int


def read_texts(chunk: wc.Chunk, o: ToxicOptions) -> Texts:
    """All overlapping windows of all words of the chunk's texts."""
    w = wc.words(chunk)
    codes = wc.SpanHash(chunk.data).of(w.starts, w.ends)
    _, first, inverse = np.unique(codes, return_index=True, return_inverse=True)
    features = word_features(chunk.data, w.starts[first], w.ends[first], o.table)
    counts = np.diff(w.before)
    windows = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - o.window) // o.stride)), 0)
    row = np.repeat(np.arange(chunk.rows), windows)
    number = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = (w.before[:-1][row] + number * o.stride)[:, None] + np.arange(o.window)
    padded = np.append(inverse, len(first))
    index = padded[np.where(at < w.before[1:][row][:, None], at, len(inverse))]
    return Texts(features, index.astype(np.int32), row, chunk.rows)


def join_texts(parts: list[Texts], o: ToxicOptions) -> Texts:
    """Several chunks' texts as one; words are distinct within a chunk only."""
    words = sum(len(p.features.word) for p in parts)
    index, row, bounds = [np.empty((0, o.window), np.int32)], [np.empty(0, np.int64)], [np.zeros(1, np.int64)]
    before = rows = grams = 0
    for p in parts:
        none = len(p.features.word)
        index.append(np.where(p.index == none, words, p.index + before).astype(np.int32))
        row.append(p.row + rows)
        bounds.append(p.features.bounds[1:] + grams)
        before, rows, grams = before + none, rows + p.rows, grams + int(p.features.bounds[-1])
    features = WordFeatures(
        np.concatenate([np.empty(0, np.int32), *(p.features.word for p in parts)]),
        np.concatenate([np.empty(0, np.int32), *(p.features.grams for p in parts)]),
        np.concatenate(bounds),
    )
    return Texts(features, np.concatenate(index), np.concatenate(row), rows)


def window_logits(net: Network, texts: Texts, block: int = 1024) -> np.ndarray:
    projected = project(net, vectors(net, texts.features))
    parts = [forward(net, projected, texts.index[i : i + block]) for i in range(0, len(texts.index), block)]
    return np.concatenate(parts) if parts else np.empty(0, _F)


def worst_logits(net: Network, texts: Texts) -> np.ndarray:
    """The highest window logit of each text; -30 if it has no word."""
    worst = np.full(texts.rows, -30.0)
    np.maximum.at(worst, texts.row, window_logits(net, texts))
    return worst


# --- Training -----------------------------------------------------------------------------


def _log_odds(counts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Per column, the shrunk log ratio of its shares of toxic and of clean texts.

    ``counts``: (2, columns) clean and toxic texts that have the column.
    """
    clean, toxic = counts
    ratio = np.log((toxic + 0.5) / (labels.sum() + 1)) - np.log((clean + 0.5) / ((1 - labels).sum() + 1))
    return ratio * (clean + toxic) / (clean + toxic + 5.0)


def _start_vectors(net: Network, texts: Texts, labels: np.ndarray) -> None:
    """Begin with each feature's log odds as the first entry of its vector."""
    f, size = texts.features, net.options.table
    none = len(f.word)
    counts = np.zeros((2, 2, size))
    ends = np.searchsorted(texts.row, np.arange(texts.rows + 1))
    for row in range(texts.rows):  # a text at a time, so memory does not follow the sample
        word = np.unique(texts.index[ends[row] : ends[row + 1]])
        word = word[word != none]
        count = f.bounds[word + 1] - f.bounds[word]
        at = np.arange(count.sum()) + np.repeat(f.bounds[word] - (np.cumsum(count) - count), count)
        counts[0, labels[row], np.unique(f.word[word])] += 1
        counts[1, labels[row], np.unique(f.grams[at])] += 1
    net.weights["words"][:, 0] = _log_odds(counts[0], labels)
    net.weights["chars"][:, 0] = _log_odds(counts[1], labels)


def _step(net: Network, name: str, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
    """Adagrad; ``rows``: the table's rows that the gradient is for."""
    squares = net._squares.setdefault(name, np.full_like(net.weights[name], 1e-2))
    if rows is None:
        squares += grad * grad
        net.weights[name] -= net.options.rate * grad / np.sqrt(squares)
    else:
        squares[rows] += grad * grad
        net.weights[name][rows] -= net.options.rate * grad / np.sqrt(squares[rows])


def _learn(net: Network, f: WordFeatures, index: np.ndarray, target: np.ndarray) -> None:
    """One step on some windows."""
    used, inverse = np.unique(index, return_inverse=True)
    real = used[used != len(f.word)]
    count = np.diff(f.bounds)[real]
    at = np.arange(count.sum()) + np.repeat(f.bounds[real] - (np.cumsum(count) - count), count)
    own = WordFeatures(f.word[real], f.grams[at], np.append(0, np.cumsum(count)))
    vector = vectors(net, own)
    logits, cache = forward(net, project(net, vector), inverse.reshape(len(index), -1), keep=True)
    d_logits = ((_sigmoid(logits) - target) / len(index)).astype(_F)
    grad, d_projected = backward(net, cache, d_logits, len(vector))
    grad["input"] = vector.T @ d_projected
    grad["bias"] = d_projected.sum(1, keepdims=True)
    d_vector = (d_projected @ net.weights["input"].transpose(0, 2, 1)).sum(0)[:-1]
    e = net.options.embed
    for name, value in grad.items():
        _step(net, name, value)
    for name, columns, value in (
        ("words", own.word, d_vector[:, e:]),
        ("chars", own.grams, np.repeat(d_vector[:, :e] / np.maximum(count, 1)[:, None], count, axis=0)),
    ):
        rows, place = np.unique(columns, return_inverse=True)
        total = np.zeros((len(rows), e), _F)
        np.add.at(total, place, value)
        _step(net, name, total, rows)


def fit(
    texts: Texts, labels: np.ndarray, o: ToxicOptions = ToxicOptions(), clean_weight: float = 1.0
) -> Network:
    """A network from labelled texts (``labels``: 0 or 1 per text). Same input, same weights.

    ``clean_weight``: how many clean texts of the corpus each clean text of the sample stands
    for, where a toxic one stands for one; it sets the level of the calibrated score.
    """
    net = new_network(o)
    rng = np.random.default_rng(o.seed)
    if not len(texts.index) or not 0 < labels.sum() < len(labels):
        net.shift = -30.0 if not labels.sum() else 30.0  # one class only
        net.scale = 0.0
        return net
    _start_vectors(net, texts, labels)
    # before the first epoch, windows are ranked by their words' mean log odds
    vector = vectors(net, texts.features)
    odds = vector[:, 0] + vector[:, o.embed]
    logits = np.concatenate([odds[texts.index[i : i + 4096]].mean(1) for i in range(0, len(texts.index), 4096)])
    toxic = labels[texts.row] == 1
    for epoch in range(o.epochs):
        if epoch:
            logits = window_logits(net, texts)
        order = np.lexsort((-logits, texts.row))
        worst = order[np.append(True, texts.row[order][1:] != texts.row[order][:-1])]
        clean = np.flatnonzero(~toxic)
        random = rng.choice(clean, min(len(clean), 2 * len(worst)), replace=False)
        chosen = np.unique(np.concatenate([worst, random]))
        # a clean text's word over and over is clean too
        word = texts.index[rng.choice(clean, len(worst))]
        word = word[np.arange(len(worst)), rng.integers(0, o.window, len(worst))]
        word = word[word != len(texts.features.word)]
        index = np.concatenate([texts.index[chosen], np.repeat(word[:, None], o.window, axis=1)])
        target = np.concatenate([labels[texts.row[chosen]], np.zeros(len(word))]).astype(_F)
        order = rng.permutation(len(index))
        for i in range(0, len(order), o.batch):
            part = order[i : i + o.batch]
            _learn(net, texts.features, index[part], target[part])
    _calibrate(net, worst_logits(net, texts), labels, np.where(labels == 1, 1.0, clean_weight))
    net._squares.clear()  # of no use after training, and tasks get what the network holds
    return net


def _calibrate(net: Network, worst: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> None:
    """Logistic regression of the labels on the worst logits, slightly held back."""
    x = np.clip(worst, -30, 30)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        d = weight * (p - labels)
        g = np.array([(d * x).sum() + 0.1 * (a - 1), d.sum() + 0.1 * b])
        v = weight * p * (1 - p)
        hess = np.array([[(v * x * x).sum() + 0.1, (v * x).sum()], [(v * x).sum(), v.sum() + 0.1]])
        change = np.linalg.solve(hess, g)
        a, b = a - float(np.clip(change[0], -1, 1)), b - float(np.clip(change[1], -1, 1))
    net.scale, net.shift = max(a, 1e-3), b


# --- Spark --------------------------------------------------------------------------------


def held_out(doc_id: str = "doc_id"):
    """Rows that no label is learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _fit_rows(batches: Iterator[pa.RecordBatch], o: ToxicOptions, total: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """One row with the pickled network that the labelled texts of all batches give."""
    rows = [row for batch in batches for row in batch.to_pylist()]
    rows.sort(key=lambda row: row["doc_id"])
    taken = {k: sum(row["toxic"] == k for row in rows) for k in (0, 1)}
    weight = (total.get(0, 0) / max(taken[0], 1)) / (total.get(1, 0) / max(taken[1], 1)) if total.get(1) else 1.0
    table = pa.array([row["text"] for row in rows], pa.string())
    target = np.array([row["toxic"] for row in rows], np.int64)
    texts = join_texts([read_texts(chunk, o) for chunk in wc.chunks(table, 4 << 20)], o)
    net = pickle.dumps(fit(texts, target, o, weight))
    yield pa.RecordBatch.from_arrays([pa.array([net], pa.binary())], names=["network"])


def train(docs: DataFrame, labels: DataFrame, o: ToxicOptions = ToxicOptions()) -> Network:
    """Fit on at most ``o.sample`` labelled texts of each class, chosen by a hash of the id.

    The sampled ids are bounded, so they go to every task; the sampled texts meet in one task,
    which trains, and the driver gets the weights.
    """
    usable = labels.where(F.col("toxic").isin(0, 1) & ~held_out()).select("doc_id", "toxic")
    sides = [usable.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id")).limit(o.sample) for k in (0, 1)]
    sample = sides[0].unionByName(sides[1]).dropDuplicates(["doc_id"])
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
    total = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    trained = texts.repartition(1).mapInArrow(lambda it: _fit_rows(it, o, total), "network binary").collect()
    if not trained:  # without any row there may be no task
        trained = [{"network": next(_fit_rows(iter(()), o, total)).column(0)[0].as_py()}]
    return pickle.loads(trained[0]["network"])


def _scores(net: Network, chunk: wc.Chunk) -> np.ndarray:
    worst = worst_logits(net, read_texts(chunk, net.options))
    return 1 / (1 + np.exp(-np.clip(net.scale * worst + net.shift, -40, 40)))


def _score(batches: Iterator[pa.RecordBatch], net: Network) -> Iterator[pa.RecordBatch]:
    o = net.options
    for batch in batches:
        parts = []
        for chunk in wc.chunks(batch.column("text")):
            parts.append(_scores(net, chunk))
        score = np.concatenate(parts) if parts else np.empty(0)
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*map(batch.column, names), pa.array(score), pa.array((score >= o.threshold).astype(np.int32))],
            names=[*names, "score", "predicted"],
        )


def _clean(batches: Iterator[pa.RecordBatch], net: Network) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        predicted = np.zeros(batch.num_rows, bool)
        for chunk in wc.chunks(batch.column("text")):
            predicted[chunk.first : chunk.first + chunk.rows] = _scores(net, chunk) >= net.options.threshold
        yield batch.filter(pa.array(~predicted))


def without_toxic(docs: DataFrame, net: Network) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under the threshold. Narrow."""
    return docs.mapInArrow(lambda it: _clean(it, net), docs.schema)


def score(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Only the text is read for the score. Null and empty texts have no window and score as
    far below all others. Null ids are kept (not held out); repeated rows score alike. An
    empty table gives no rows. Narrow: no shuffle.
    """
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(
        lambda it: _score(it, net), f"doc_id {kind}, held_out boolean, score double, predicted int"
    )
