"""Quality by co-training of two views of a document.

The content view is the mix of three-byte sequences of the text. The metadata view is what is known of the
page: source, language, length, and its layout (lines, their length, how many repeat). Each view has a
logistic classifier. Over ``ROUNDS`` rounds each marks the unlabelled documents it is surest of, in the
proportion of the labelled classes, and the other learns from them. Then both are calibrated on labelled
documents kept apart, joined by a logistic curve over their log odds, and all documents are scored.

Training takes at most LABELLED_ROWS labelled and UNLABELLED_ROWS other documents, those with the smallest hash
of their id; their features, of fixed size, go to the driver. Scores are probabilities of good quality. Null
texts count as empty, null metadata is a value of its own; a null label doesn't count, of several labels of a
doc_id the smallest does. Without labels of both classes every score is 1: nothing is rejected that was not
learnt. Rows that repeat are scored one by one; other columns are ignored or kept, whatever their names; an empty
table gives no rows. Long texts are read a megabyte at a time."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from regtables.llm.common import free_names, parts_of, slices

LABELLED_ROWS = 3000
UNLABELLED_ROWS = 3000
ROUNDS = 3
MARKED_SHARE = 0.1  # of the unlabelled documents, marked by each view in a round
SURE = 0.9
REJECT_BELOW = 0.3
CONTENT_PLACES = 1024
SOURCE_PLACES = 64
_METADATA = ("lang", "source", "n_chars")


def content_features(data: bytes) -> np.ndarray:
    """Shares of hashed three-byte sequences of the whole text, as square roots."""
    counts = np.zeros(CONTENT_PLACES)
    for part in parts_of(data, overlap=2):
        b = np.frombuffer(part, np.uint8).astype(np.uint32)
        if len(b) > 2:
            h = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA6B) ^ b[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
            counts += np.bincount(h >> np.uint32(22), minlength=CONTENT_PLACES)
    return np.sqrt(counts / max(1.0, counts.sum()))


def _place(kind: str, value) -> int:
    return zlib.crc32(f"{kind}={value}".encode()) % SOURCE_PLACES


def metadata_features(lang, source, n_chars, data: bytes) -> np.ndarray:
    lines = data.split(b"\n")
    layout = np.zeros(6)
    layout[0] = np.log1p(n_chars or 0) / 10
    layout[1] = np.log1p(len(lines)) / 5
    layout[2] = np.log1p(len(data) / len(lines)) / 10
    layout[3] = 1 - len(set(lines)) / len(lines)
    layout[4] = n_chars is None
    layout[5] = not data
    named = np.zeros(2 * SOURCE_PLACES)
    named[_place("lang", lang)] = 1
    named[SOURCE_PLACES + _place("source", source)] = 1
    return np.concatenate([layout, named])


VIEW_SIZES = (CONTENT_PLACES, 6 + 2 * SOURCE_PLACES)


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column("text")]
    meta = zip(*(batch.column(c).to_pylist() for c in _METADATA), data, strict=True)
    content = np.array([content_features(d) for d in data]).reshape(-1, VIEW_SIZES[0])
    return content, np.array([metadata_features(*m) for m in meta]).reshape(-1, VIEW_SIZES[1])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3, steps: int = 120) -> np.ndarray:
    """Weights and intercept of a penalised logistic regression, by accelerated gradients. Products are taken
    in the precision of ``x``, so that it is not copied for them."""
    x = np.column_stack([x, np.ones(len(x), x.dtype)])
    share = weight / weight.sum()
    forward = lambda u: x @ u.astype(x.dtype)
    back = lambda r: (r.astype(x.dtype) @ x).astype(np.float64)
    v = np.ones(x.shape[1])
    for _ in range(15):
        v = back(share * forward(v))
        size = np.linalg.norm(v)
        v /= size
    rate = 1 / (0.25 * size * 1.1 + penalty)
    w = z = np.zeros(x.shape[1])
    t = 1.0
    for _ in range(steps):
        slope = back(share * (_curve(forward(z)) - y)) + penalty * np.append(z[:-1], 0)
        following = z - rate * slope
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = following + (t - 1) / s * (following - w)
        w, t = following, s
    return w


def _curve(a: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(a, -30, 30)))


def _margin(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class Model:
    views: list[np.ndarray]
    calibration: list[np.ndarray]
    joint: np.ndarray

    def scores(self, views: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of the content view, of the metadata view, and of both."""
        odds = [_margin(c, _margin(w, x)[:, None]) for w, c, x in zip(self.views, self.calibration, views, strict=True)]
        return _curve(odds[0]), _curve(odds[1]), _curve(_margin(self.joint, np.column_stack(odds)))


def co_train(labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, unlabelled: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS) -> Model | None:
    """A third of the labelled documents is kept for calibration."""
    apart = np.arange(len(y)) % 3 == 0
    if min(len(set(y[apart])), len(set(y[~apart]))) < 2:
        return None
    n_free = len(unlabelled[0])
    share = y[~apart].mean()
    # What each view has been told of the unlabelled documents: 1, 0, or -1 for nothing.
    told = [np.full(n_free, -1), np.full(n_free, -1)]
    views = []
    for turn in range(rounds + 1):
        views = []
        for k in range(2):
            known = np.flatnonzero(told[k] >= 0)
            x = np.concatenate([labelled[k][~apart], unlabelled[k][known]])
            target = np.concatenate([y[~apart], told[k][known]])
            weight = np.concatenate([np.ones((~apart).sum()), np.full(len(known), 0.5)])
            views.append(logistic(x, target, weight))
        if turn == rounds or not n_free:
            break
        for k in range(2):
            p = _curve(_margin(views[k], unlabelled[k]))
            n = MARKED_SHARE * n_free
            for label, sure, quota in ((1, p, n * share), (0, 1 - p, n * (1 - share))):
                fresh = np.where(told[1 - k] < 0, sure, 0)
                best = np.argsort(-fresh, kind="stable")[: int(np.ceil(quota))]
                told[1 - k][best[fresh[best] >= SURE]] = label
    margins = [_margin(w, x[apart]) for w, x in zip(views, labelled, strict=True)]
    ones = np.ones(apart.sum())
    calibration = [logistic(m[:, None], y[apart], ones, 1e-4, 400) for m in margins]
    odds = np.column_stack([_margin(c, m[:, None]) for c, m in zip(calibration, margins, strict=True)])
    return Model(views, calibration, logistic(odds, y[apart], ones, 1e-4, 400))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        views = _features(batch)
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), batch.column("turn"), *(pa.array([v.astype("<f4").tobytes() for v in x], pa.binary()) for x in views)], names=["label", "turn", "content", "metadata"]
        )


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Ids are picked first, by hash; then the features of the picked documents are made in tasks."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))
    turn = F.xxhash64("doc_id").alias("turn")
    ids = docs.select("doc_id").where("doc_id is not null")
    with_label = ids.join(known, "doc_id").select("doc_id", "label", turn).orderBy("turn", "doc_id").limit(LABELLED_ROWS)
    without = ids.join(known, "doc_id", "left_anti").select("doc_id", F.lit(None).cast("int").alias("label"), turn).orderBy("turn", "doc_id").limit(UNLABELLED_ROWS)
    picked = with_label.unionAll(without.select("doc_id", "label", "turn")).dropDuplicates(["doc_id"])
    rows = docs.select("doc_id", "text", *_METADATA).join(F.broadcast(picked), "doc_id").drop("doc_id")
    found = rows.mapInArrow(_vectors, "label int, turn bigint, content binary, metadata binary")
    # A row per picked id, however often it repeats.
    found = found.groupBy("turn").agg(F.min(F.struct("label", "content", "metadata")).alias("v")).select("v.label", "turn", "v.content", "v.metadata").toPandas()
    found = found.sort_values(["turn", "content", "metadata"], kind="stable")
    if not len(found):
        return None
    views = [np.stack([np.frombuffer(v, "<f4") for v in found[c]]) for c in ("content", "metadata")]
    found = found[["label"]]
    is_known = found["label"].notna().to_numpy()
    y = found["label"][is_known].to_numpy(np.float64)
    return co_train(tuple(v[is_known] for v in views), y, tuple(v[~is_known] for v in views))


def _score(model, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in slices(batches):
            views = _features(batch)
            found = m.scores(views) if m else (np.ones(batch.num_rows),) * 3
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, found)], names=[*kept, *_SCORES])

    return run


_SCORES = ("content_score", "metadata_score", "score")


def _scored(docs: DataFrame, labels: DataFrame, kept: list[str]) -> tuple[DataFrame, list[str]]:
    """The ``kept`` columns and three scores, and how these are named."""
    names = free_names(kept, *_SCORES)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))  # a weight per feature
    # Tasks get the kept columns by number: names may be anything.
    own = [f"kept{i}" for i in range(len(kept))]
    rows = docs.select(*(F.col(f"`{c}`").alias(o) for c, o in zip(kept, own, strict=True)), "text", *_METADATA)
    fields = [*(T.StructField(o, docs.schema[c].dataType) for c, o in zip(kept, own, strict=True)), *(T.StructField(n, T.DoubleType()) for n in _SCORES)]
    return rows.mapInArrow(_score(model, own), T.StructType(fields)).toDF(*kept, *names), names


def quality(docs: DataFrame, labels: DataFrame, reject_below: float = REJECT_BELOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, content_score, metadata_score, score, kept."""
    found, (content, metadata, score) = _scored(docs, labels, ["doc_id"])
    return found.select("doc_id", content, metadata, score, (F.col(score) >= reject_below).alias("kept"))


def accepted(docs: DataFrame, labels: DataFrame, reject_below: float = REJECT_BELOW) -> DataFrame:
    """``docs`` without the rows of poor quality, all columns kept. Nothing is shuffled."""
    found, (_, _, score) = _scored(docs, labels, docs.columns)
    return found.where(F.col(score) >= reject_below).select(*(F.col(f"`{c}`") for c in docs.columns))
