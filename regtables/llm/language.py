"""Language of whole texts by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows of about the same length, at most ``WINDOW`` bytes, that cover all of it.
In each window one network reads forwards and one backwards; what both know at a byte gives that byte's language
probabilities. A document's are the mean over its letter bytes (A-Z, a-z and all beyond ASCII). The network is
trained in numpy by backpropagation through time: every byte of a training window is to get its document's language.

Training takes ``PER_LANGUAGE`` documents of each language, those with the smallest hash of their id, and
``WINDOWS_EACH`` windows spread over each; windows, not texts, go to the driver. Only rows with a lang and a doc_id
outside the held-out fold are learnt from; the values of lang are the classes and are taken to be few. Predictions
depend on the text alone.

A text that is null or has no letter gets ``und`` and the score 0, as do all texts if nothing could be learnt. A null
doc_id counts as held out. Rows that repeat are predicted one by one, those of one doc_id share a place in the
choice of training documents by hash. Ties between languages go to the first by name. Long texts are windows like
others, a few thousand at a time. Other columns are ignored, whatever their names; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from regtables.llm.common import slices

WINDOW = 96
HIDDEN = 16
PER_LANGUAGE = 700
WINDOWS_EACH = 4
SPARE = 4
STEPS = 200
BATCH = 192
RATE = 0.02
HELD_FOLD, FOLDS = 0, 5
UNKNOWN = "und"
AT_ONCE = 1024  # windows that go through the network together

# Whether a byte is of a letter, for all we can tell from the byte.
_IS_LETTER = np.array([c >= 128 or chr(c).isalpha() for c in range(256)])


@dataclass
class Network:
    """Parameters of both directions: ``given`` (3, 2, 256, h) by byte, ``own`` (3, 2, h, h) by state, ``shift`` (2, 1, h),
    ``out`` (2, classes, h) and ``bias`` (classes, 1). The three parts are the update gate, the reset gate (both of
    half their argument, for a tanh) and the candidate."""

    names: list[str]
    given: np.ndarray
    own: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.given, self.own, self.shift, self.out, self.bias]

    @classmethod
    def fresh(cls, names: list[str], hidden: int, rng: np.random.Generator) -> Network:
        draw = lambda *shape, size: (rng.standard_normal(shape) * size).astype("<f4")
        return cls(
            names, draw(3, 2, 256, hidden, size=0.3), draw(3, 2, hidden, hidden, size=0.5 / hidden**0.5), np.zeros((2, 1, hidden), "<f4"),
            draw(2, len(names), hidden, size=0.3), np.zeros((len(names), 1), "<f4"),
        )


def windows(lengths: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and document of the windows of documents that lie one after another."""
    n = -(-lengths // size)
    doc = np.repeat(np.arange(len(lengths)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    base = (np.cumsum(lengths) - lengths)[doc]
    start, end = k * lengths[doc] // n[doc], (k + 1) * lengths[doc] // n[doc]
    return base + start, end - start, doc


def both_ways(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Bytes of windows (steps, 2, windows), read forwards and, with 256 added, backwards. What lies behind a window's
    end doesn't matter."""
    t = np.arange(length.max())[:, None]
    forward, backward = np.minimum(start + t, len(data) - 1), np.maximum(start + length - 1 - t, 0)
    return np.stack([data[forward].astype(np.intp), data[backward].astype(np.intp) + 256], 1)


def mirror(length: np.ndarray, steps: int) -> np.ndarray:
    """For each position (steps, 1, windows), the step at which the backward network comes to it."""
    return np.maximum(length - 1 - np.arange(steps)[:, None], 0)[:, None]


def _states(net: Network, ids: np.ndarray, keep: list | None = None) -> Iterator[np.ndarray]:
    """The states (2, windows, hidden) after each step. ``keep`` gets what going back needs."""
    h = net.own.shape[-1]
    by_byte = net.given.reshape(3, 512, h)
    state = np.zeros((2, ids.shape[2], h), net.own.dtype)
    for t in range(len(ids)):
        update, reset, candidate = (np.take(rows, ids[t], 0) for rows in by_byte)
        for gate, own in ((update, net.own[0]), (reset, net.own[1])):
            gate += state @ own
            np.tanh(gate, out=gate)
            gate *= 0.5
            gate += 0.5
        heard = state @ net.own[2]
        heard += net.shift
        candidate += reset * heard
        np.tanh(candidate, out=candidate)
        before, state = state, state - candidate
        state *= update
        state += candidate
        if keep is not None:
            keep.append((before, update, reset, heard, candidate))
        yield state


def _softmax(a: np.ndarray) -> np.ndarray:
    """Over the classes, the axis before the last."""
    a -= a.max(-2, keepdims=True)
    np.exp(a, out=a)
    a /= a.sum(-2, keepdims=True)
    return a


def position_probabilities(net: Network, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Language probabilities (longest, classes, windows) at each byte of windows of ``data``."""
    logits = np.stack([net.out @ s.transpose(0, 2, 1) for s in _states(net, both_ways(data, start, length))])
    return _softmax(logits[:, 0] + np.take_along_axis(logits[:, 1], mirror(length, len(logits)), 0) + net.bias)


def gradients(net: Network, data: np.ndarray, start: np.ndarray, length: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over all bytes of the windows, and its gradient by each parameter."""
    ids, keep = both_ways(data, start, length), []
    states = np.stack(list(_states(net, ids, keep)))  # steps, 2, windows, hidden
    steps, n, h = len(states), len(start), states.shape[-1]
    turn = mirror(length, steps)
    logits = net.out @ states.transpose(0, 1, 3, 2)
    p = _softmax(logits[:, 0] + np.take_along_axis(logits[:, 1], turn, 0) + net.bias)  # steps, classes, windows
    inside = np.arange(steps)[:, None] < length
    share = (inside / inside.sum()).astype(p.dtype)
    right = np.take_along_axis(p, np.broadcast_to(target, (steps, 1, n)), 1)[:, 0]
    loss = -float((np.log(np.maximum(right, 1e-9)) * share).sum())

    slope = (p - (np.arange(len(net.names))[:, None] == target)) * share[:, None]
    # Mirroring twice gives each position back, as far as the window goes; beyond, slopes are zero.
    slopes = np.stack([slope, np.take_along_axis(slope, turn, 0) * inside[:, None]], 1)  # steps, 2, classes, windows
    d_out = (slopes @ states).sum(0)
    from_out = slopes.transpose(0, 1, 3, 2) @ net.out  # steps, 2, windows, hidden

    d_own, d_shift = np.zeros_like(net.own), np.zeros_like(net.shift)
    pre = np.empty((3, steps, 2, n, h), p.dtype)
    d_state = np.zeros((2, n, h), p.dtype)
    for t in range(steps - 1, -1, -1):
        before, update, reset, heard, candidate = keep[t]
        d_state = d_state + from_out[t]
        d_candidate = d_state * (1 - update) * (1 - candidate * candidate)
        pre[0, t] = d_state * (before - candidate) * (2 * update * (1 - update))
        pre[1, t] = d_candidate * heard * (2 * reset * (1 - reset))
        pre[2, t] = d_candidate
        d_state = d_state * update
        for k, d in enumerate((pre[0, t], pre[1, t], d_candidate * reset)):
            d_own[k] += before.transpose(0, 2, 1) @ d
            d_state += d @ net.own[k].transpose(0, 2, 1)
        d_shift += d.sum(1, keepdims=True)
    # Sums by byte.
    order = np.argsort(ids, axis=None, kind="stable")
    used, first = np.unique(ids.reshape(-1)[order], return_index=True)
    d_given = np.zeros_like(net.given)
    for rows, d in zip(d_given.reshape(3, 512, h), pre.reshape(3, -1, h), strict=True):
        rows[used] = np.add.reduceat(d[order], first, 0)
    return loss, [d_given, d_own, d_shift, d_out, slope.sum((0, 2))[:, None]]


def fit(texts: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 1) -> Network | None:
    """A network trained on windows of text. Each language has the same part in every step."""
    names = sorted(set(labels))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    net = Network.fresh(names, hidden, rng)
    lengths = np.array([len(t) for t in texts])
    data, starts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(lengths) - lengths
    target = np.array([names.index(x) for x in labels])
    of_class = [np.flatnonzero((target == k) & (lengths > 0)) for k in range(len(names))]
    of_class = [c for c in of_class if len(c)]
    mean = [np.zeros_like(p) for p in net.parameters]
    square = [np.zeros_like(p) for p in net.parameters]
    for step in range(steps if of_class else 0):
        picked = np.concatenate([rng.choice(c, -(-BATCH // len(of_class))) for c in of_class])
        _, slopes = gradients(net, data, starts[picked], lengths[picked], target[picked])
        size = max(1.0, float(np.sqrt(sum((g.astype(np.float64) ** 2).sum() for g in slopes))))
        rate = RATE * (1 - step / steps) + 1e-4
        for p, g, m, v in zip(net.parameters, slopes, mean, square, strict=True):
            g = g / size
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.99 ** (step + 1))) + 1e-6)).astype("<f4")
    return net


def document_probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean of the probabilities at each document's letter bytes (documents, classes); zeros where there is none."""
    data, lengths = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts])
    start, length, doc = windows(lengths)
    total, letters = np.zeros((len(texts), len(net.names))), np.zeros(len(texts))
    order = np.argsort(-length, kind="stable")
    for i in range(0, len(order), AT_ONCE):
        part = order[i : i + AT_ONCE]
        p = position_probabilities(net, data, start[part], length[part])
        t = np.arange(len(p))[:, None]
        counted = (t < length[part]) & _IS_LETTER[data[np.minimum(start[part] + t, len(data) - 1)]]
        np.add.at(total, doc[part], (p * counted[:, None]).sum(0).T)
        np.add.at(letters, doc[part], counted.sum(0))
    return total / np.maximum(letters, 1)[:, None]


def has_letter(data: bytes) -> bool:
    if any(65 <= c <= 90 or 97 <= c <= 122 for c in data[:64]):
        return True
    return any(c.isalpha() for c in data.decode("utf-8", "ignore"))


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in batch.column("text")]


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document windows spread over its text."""
    for batch in slices(batches):
        kept, found = [], []
        for i, data in enumerate(_bytes(batch)):
            start, length, _ = windows(np.array([len(data)]))
            places = sorted({(2 * k + 1) * len(start) // (2 * WINDOWS_EACH) for k in range(WINDOWS_EACH)}) if len(start) else []
            for k in places:
                kept.append(i)
                found.append(data[start[k] : start[k] + length[k]])
        columns = [batch.column(c).take(pa.array(kept, pa.int64())) for c in ("lang", "turn")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], names=["lang", "turn", "window"])


def _fold(docs: DataFrame) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_FOLD, F.lit(True))
    return docs.withColumn("held_out", held)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, **settings) -> Network | None:
    """A network that has learnt from a bounded sample of ``docs`` (doc_id, text, lang). Ids are chosen first, from
    two small columns; then windows are cut from their texts, a bounded number of a language again."""
    known = _fold(docs.select("doc_id", "lang", "text")).where("lang is not null and not held_out")
    first = lambda n, *order: F.row_number().over(Window.partitionBy("lang").orderBy(*order)) <= n
    ids = known.select("lang", "doc_id", F.xxhash64("doc_id").alias("turn")).where("doc_id is not null")
    # A row per language. Ids with a small enough hash are some SPARE times as many as are wanted, at every size.
    n_rows = F.broadcast(ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    likely = (F.col("turn") / 2.0**64 + 0.5) * F.col("n") < SPARE * per_language
    ids = ids.join(n_rows, "lang").where(likely).select("lang", "doc_id", "turn").distinct()
    ids = ids.withColumn("chosen", first(per_language, "turn", "doc_id")).where("chosen").select("doc_id", "turn").distinct()
    # At most per_language ids of a language.
    texts = known.select("doc_id", "lang", "text").join(F.broadcast(ids), "doc_id").select("lang", "turn", "text")
    found = texts.mapInArrow(_sample, "lang string, turn bigint, window binary")
    found = found.withColumn("chosen", first(per_language * WINDOWS_EACH, "turn", "window")).where("chosen").orderBy("lang", "turn", "window").collect()
    return fit([bytes(r.window) for r in found], [r.lang for r in found], **settings)


def _predict(net):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = _bytes(batch)
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if has_letter(t)] if net.value else []
            if known:
                p = document_probabilities(net.value, [texts[i] for i in known])
                best = p.argmax(1)
                for i, k, own in zip(known, best, p, strict=True):
                    names[i], scores[i] = net.value.names[k], own[k]
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(np.clip(scores, 0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def languages(docs: DataFrame, net: Network | None = None, **settings) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score."""
    net = net or train(docs, **settings)
    sent = docs.sparkSession.sparkContext.broadcast(net)  # some ten thousand numbers
    rows = _fold(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    return rows.mapInArrow(_predict(sent), "doc_id bigint, held_out boolean, lang_pred string, score double")


def _runs(net):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), _bytes(batch), strict=True):
                start, length, _ = windows(np.array([len(data)]))
                raw, labels = np.frombuffer(data, np.uint8), []
                for i in range(0, len(start), AT_ONCE):
                    p = position_probabilities(net.value, raw, start[i : i + AT_ONCE], length[i : i + AT_ONCE])
                    labels += [p[:n, :, k].argmax(1) for k, n in enumerate(length[i : i + AT_ONCE])]
                label = np.concatenate([*labels, np.zeros(0, np.int64)])
                first = np.flatnonzero(np.diff(label, prepend=-1))
                rows += [(doc_id, int(a), int(n), net.value.names[label[a]]) for a, n in zip(first, np.diff(first, append=len(label)), strict=True)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "start", "length", "lang"])

    return run


def language_runs(docs: DataFrame, net: Network) -> DataFrame:
    """The label of every byte: doc_id, start, length (in bytes), lang; a row per run of the same label."""
    sent = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_runs(sent), "doc_id bigint, start bigint, length bigint, lang string")
