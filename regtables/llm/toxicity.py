"""Toxic text by compression distance.

Windows are ``WINDOW_WORDS`` words that follow each other, lower-cased. Two zstandard dictionaries are trained on labelled
documents: both hold the most frequent words of ordinary text, and at their near end, where matches are cheapest,
segments (4 to 10 characters of words that two documents of the kind have, with the spaces around) that toxic documents
have more often than ordinary ones, and the other way round. A window's gain is what it takes less with the toxic dictionary than with the
ordinary one. Gains of a whole document (the largest, and how many reach ``WINDOW_GAIN``) give its score through a
logistic curve, calibrated on labelled documents that the dictionaries have not seen. These also choose how long the
near ends are: a longer one knows more segments, but makes each of them dearer.

Training takes at most TOXIC_ROWS and ORDINARY_ROWS labelled documents, those with the smallest hash of their id, one
text of each id. Their texts stay in tasks: the driver gets document counts of MAX_WORDS words at most, and a few
numbers per document. Scores depend on the text alone.

Null and empty texts have no window and get the score of no gain; a label that is null doesn't count, of several labels
of a doc_id the largest does. Without labels of both kinds the score is the share of toxic labels, 0 if there are none.
Rows that repeat are scored one by one; other columns are ignored, whatever their names; an empty table gives no
rows. Of a long text all windows are compressed, a slice at a time."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from regtables.llm.common import slices, texts_of, work_folder, written

TOXIC_ROWS = 1500
ORDINARY_ROWS = 3000
MAX_WORDS = 200_000
BASE_BYTES = 12_000
NEAR_BYTES = (200, 400, 800, 1600)  # of which calibration chooses one
SEGMENT_CHARS = (4, 10)
LEAST_DOCUMENTS = 3  # that have a segment
WINDOW_WORDS = 3
WINDOW_GAIN = 4
N_FEATURES = 5
HELD_FOLD, FOLDS = 2, 4
THRESHOLD = 0.3
KEPT_WINDOWS = 100_000

# Opens every window and ends every dictionary, so that blocks are always compressed, never stored.
_LEAD = bytes([1, 2, 3, 4, 5, 6, 7, 8, 16, 15, 17, 14, 18, 11, 19, 12, 20, 21, 22, 26, 23, 27, 24, 28, 25, 29, 30, 31])


def windows(text: str) -> list[str]:
    words = text.lower().split()
    return [" ".join(words[i : i + WINDOW_WORDS]) for i in range(0, len(words), WINDOW_WORDS)]


def _segments_of(word: str) -> set[str]:
    framed, (low, high) = f" {word} ", SEGMENT_CHARS
    return {framed[i : i + n] for n in range(low, high + 1) for i in range(len(framed) - n + 1)}


def segments(counts: list[tuple[str, int, int]], n_own: int, n_other: int) -> list[str]:
    """Segments that documents of one kind have and few of the other, those that gain most first. counts: words with
    the number of documents of either kind that have them. A segment's count is the sum over its words, less its
    square root, as small counts are chance. Of segments inside each other the better one is kept."""
    own_times: dict[str, int] = {}
    other_times: dict[str, int] = {}
    for word, own, other in counts:
        if own > 1 and own / n_own > 5 * other / n_other:
            own_times.update(dict.fromkeys(_segments_of(word), 0))
    for word, own, other in counts:
        for x in _segments_of(word):
            if x in own_times:
                own_times[x] += own
                if other:
                    other_times[x] = other_times.get(x, 0) + other
    worth: dict[str, float] = {}
    for x, n in own_times.items():
        against = other_times.get(x, 0)
        lead = (n - n**0.5) / n_own - 5 * (against + 0.5 * against**0.5) / n_other
        if n >= LEAST_DOCUMENTS and lead > 0:
            worth[x] = lead * (len(x) - 2)  # a match of two characters gains nothing
    found: list[str] = []
    size = 0
    for x in sorted(worth, key=lambda x: (-worth[x], x)):
        if not any(x in y or y in x for y in found):
            found.append(x)
            size += len(x.encode())
            if size > max(NEAR_BYTES):
                break
    return found


def _near_end(found: list[str], limit: int) -> bytes:
    """The best segments within ``limit`` bytes, the best last."""
    kept, size = [], 0
    for x in found:
        size += len(x.encode())
        if size > limit:
            break
        kept.append(x)
    return "".join(reversed(kept)).encode() + b" "


def train_dictionaries(counts: list[tuple[str, int, int]], n_toxic: int, n_ordinary: int) -> list[tuple[bytes, bytes]]:
    """The toxic and the ordinary dictionary, for each of NEAR_BYTES. counts: words with the number of toxic and of
    ordinary documents that have them."""
    frequent = sorted(counts, key=lambda c: (-c[2], c[0]))
    base = "".join(f" {w} " for w, _, n in frequent[:BASE_BYTES] if n).encode()[:BASE_BYTES]
    ends = segments(counts, n_toxic, n_ordinary), segments([(w, b, a) for w, a, b in counts], n_ordinary, n_toxic)
    return [tuple(base + _near_end(found, limit) + _LEAD for found in ends) for limit in NEAR_BYTES]


class Gains:
    """Gains of windows under two dictionaries; those of lately seen windows are looked up."""

    def __init__(self, dictionaries: tuple[bytes, bytes]):
        self.compress = [self._compressor(d).compress for d in dictionaries]
        self.known: dict[str, int] = {}

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        settings = zstandard.ZstdCompressionParameters(
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
            window_log=17, chain_log=16, hash_log=16, search_log=5, min_match=3, target_length=32, strategy=zstandard.STRATEGY_BTOPT,
        )
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)

    def of(self, texts: list[str]) -> list[np.ndarray]:
        cut = [windows(t) for t in texts]
        wanted = set()
        for own in cut:
            wanted.update(own)
        new = wanted.difference(self.known)
        if len(self.known) + len(new) > KEPT_WINDOWS:
            self.known.clear()
            new = wanted
        toxic, ordinary = self.compress
        known = self.known
        for w in new:
            data = _LEAD + f" {w} ".encode()
            known[w] = len(ordinary(data)) - len(toxic(data))
        return [np.array([known[w] for w in own], np.int64) for own in cut]


def features(gains: np.ndarray) -> np.ndarray:
    top = np.sort(gains)[::-1][:5].clip(min=0)
    hits = int((gains >= WINDOW_GAIN).sum())
    n = len(gains)
    return np.array([top.sum(), top.max(initial=0), np.log1p(hits), 100 * hits / max(n, 1), np.log1p(n)])


class Model:
    """Dictionaries and the curve. ``share``: the score where there is nothing to learn from."""

    def __init__(self, dictionaries=None, center=None, scale=None, weights=None, share: float = 0.0):
        self.dictionaries, self.center, self.scale, self.weights, self.share = dictionaries, center, scale, weights, share

    def curve(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.center) / self.scale
        return 1 / (1 + np.exp(-np.clip(z @ self.weights[:-1] + self.weights[-1], -30, 30)))

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.dictionaries is None:
            return np.full(len(texts), self.share)
        return self.curve(np.array([features(g) for g in _gains(self.dictionaries).of(texts)]).reshape(-1, N_FEATURES))


@lru_cache(maxsize=2)
def _gains(dictionaries: tuple[bytes, bytes]) -> Gains:
    return Gains(dictionaries)


def calibrated(dictionaries: tuple[bytes, bytes], x: np.ndarray, y: np.ndarray) -> Model:
    """A logistic curve over the features ``x`` of documents labelled ``y``."""
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([(x - center) / scale, np.ones(len(x))])
    weights = np.zeros(z.shape[1])
    penalty = np.diag([*[0.5] * (z.shape[1] - 1), 1e-6])
    for _ in range(50):  # Newton's method on the penalised likelihood
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ weights)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return Model(dictionaries, center, scale, weights)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        kinds = Counter(), Counter()
        for toxic, text in zip(batch.column("toxic").to_pylist(), texts_of(batch), strict=True):
            kinds[0 if toxic else 1].update(set(text.lower().split()))
        words = list(kinds[0].keys() | kinds[1].keys())
        columns = [pa.array(words, pa.string()), *(pa.array([k[w] for w in words], pa.int64()) for k in kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "toxic", "ordinary"])


def _features(choices):
    """Features under each pair of dictionaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = [Gains(d) for d in choices.value]
        for batch in slices(batches):
            found = [[features(x) for x in g.of(texts_of(batch))] for g in gains]
            rows = [np.concatenate(own).tolist() for own in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "toxic", "features"])

    return run


def train(docs: DataFrame, labels: DataFrame, fold=HELD_FOLD, folds: int = FOLDS) -> Model:
    """Learns from labelled documents outside ``fold``. Of the labels, ids are picked first; then only the
    picked documents are read, a text of each. Two thirds of them make the dictionaries, the rest calibrates."""
    spark = docs.sparkSession
    ids = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = ids.where(F.crc32(F.col("doc_id").cast("string")) % folds != fold).withColumn("toxic", (F.col("toxic") == 1).cast("int"))
    few = lambda kind, n: ids.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    picked = F.broadcast(few(1, TOXIC_ROWS).unionAll(few(0, ORDINARY_ROWS)))
    texts = docs.select("doc_id", "text").where("text is not null").join(picked, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    sample = written(texts, f"{work_folder(spark, 'toxicity')}/sample")
    n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(n.get(0, 0), n.get(1, 0)) < 3:
        return Model(share=n.get(1, 0) / max(1, sum(n.values())))
    is_apart = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), 3) == 0
    seen = sample.where(~is_apart)
    kinds = {r.toxic: r.n for r in seen.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = seen.select("text", "toxic").mapInArrow(_word_counts, "word string, toxic bigint, ordinary bigint").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    counts = counts.where("toxic + ordinary > 1").orderBy(F.desc(F.col("toxic") + F.col("ordinary")), "word").limit(MAX_WORDS)
    choices = train_dictionaries([tuple(r) for r in counts.collect()], max(1, kinds.get(1, 0)), max(1, kinds.get(0, 0)))
    apart = sample.where(is_apart).mapInArrow(_features(spark.sparkContext.broadcast(choices)), "doc_id bigint, toxic int, features array<double>")
    rows = sorted(apart.collect())  # a few numbers per picked document
    y = np.array([r.toxic for r in rows], float)
    if len(set(y)) < 2:
        return Model(share=n.get(1, 0) / sum(n.values()))
    x = np.array([r.features for r in rows])
    models = [calibrated(d, x[:, k * N_FEATURES : (k + 1) * N_FEATURES], y) for k, d in enumerate(choices)]
    loss = lambda p: -np.log(np.where(y == 1, p, 1 - p).clip(1e-9)).mean()
    losses = [loss(m.curve(x[:, k * N_FEATURES : (k + 1) * N_FEATURES])) for k, m in enumerate(models)]
    return models[int(np.argmin(losses))]


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.value.scores(texts_of(batch)))], names=["doc_id", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fold=HELD_FOLD, folds: int = FOLDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, fold, folds))  # two dictionaries of some 15 kB
    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_score(model), "doc_id bigint, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
