"""Toxicity by a convolutional text classifier, trained in numpy.

A word's vector is the sum of hashed embeddings of the word, its first three, four and five
bytes and its last three. Filters over one, two and three words, max-pooling over the whole
text and a logistic layer give the logit. Training starts from class log-odds in one
embedding dimension and follows the pooled positions only, with AdaGrad.

Scores are calibrated by language: a text's language is guessed from its function words
(the ``lang`` column is not read), and the logit is shifted so that 0.5 is the threshold with
the best F1 for that language on a fold that the fit did not see. Languages with few toxic
calibration rows are drawn towards the common threshold.

The fit uses at most TRAIN_ROWS rows of each class, those with the smallest hashes of
doc_id; scoring is a map over whole texts with the model (2 MB) broadcast.

Defined results: null and empty texts have no words and get the score of the bias; without
a toxic and a clean training row every score is 0. Labels that are null are not used; of
several labels of one doc_id the largest counts. Rows come back one for one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtrend.llm.common import Words, mix64, slices, spread, whole_row

#: Rows of each class that a fit uses at most.
TRAIN_ROWS = 4000
BUCKETS = 1 << 16
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 6
BATCH = 64
RATE = 0.05
PAD = 3
#: Toxic calibration rows that weigh as much as the common threshold.
SHRINK = 20
#: Frequent function words of each language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was with as be on by this are from at or".split(),
    "de": "der die und das den von zu mit im für ist des dem nicht ein eine als auch auf sich".split(),
    "fr": "le la les des et du un une est dans qui sur pour par au avec il ne pas ce".split(),
    "es": "el los las de que y en un una por con para su no se del al lo es como".split(),
}


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _edge_hash(words: Words, size: int, head: bool) -> np.ndarray:
    """A hash of each word's first or last ``size`` bytes (fewer if it is shorter)."""
    out = np.full(len(words.start), size * 2 + head, np.uint64)
    for i in range(size):
        at = words.start + i if head else words.end - 1 - i
        inside = at < words.end if head else at >= words.start
        byte = np.where(inside, words.norm[np.clip(at, 0, max(len(words.norm) - 1, 0))], 0) if len(words.norm) else np.zeros(len(at), np.uint8)
        out = (out + byte.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return out


def features(words: Words) -> np.ndarray:
    """Bucket numbers: a row a word, a column an embedding that its vector sums."""
    parts = [words.hash, _edge_hash(words, 3, True), _edge_hash(words, 4, True), _edge_hash(words, 5, True), _edge_hash(words, 3, False)]
    return np.stack([(mix64(p + np.uint64(k)) >> np.uint64(48)).astype(np.uint16) for k, p in enumerate(parts)], axis=1)


def languages(words: Words) -> np.ndarray:
    """For each text the number of the language with most function words, -1 if none has any."""
    names = list(FUNCTION_WORDS)
    counts = np.zeros((words.n_docs, len(names)), np.int64)
    for k, name in enumerate(names):
        own = Words(pa.array([" ".join(FUNCTION_WORDS[name])])).hash
        counts[:, k] = np.bincount(words.doc[np.isin(words.hash, own)], minlength=words.n_docs)
    return np.where(counts.max(axis=1) > 0, counts.argmax(axis=1), -1)


@dataclass
class Model:
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    thresholds: np.ndarray  # by language; the last one holds where none is known

    def _vectors(self, buckets: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word vectors with PAD zero vectors after each text, and where texts start."""
        starts = np.cumsum(counts + PAD) - counts - PAD
        x = np.zeros((int((counts + PAD).sum()), DIMENSIONS), np.float32)
        owner, place = spread(counts)
        vectors = self.embedding[buckets[:, 0]]
        for k in range(1, buckets.shape[1]):
            vectors += self.embedding[buckets[:, k]]
        x[starts[owner] + place] = vectors
        return x, starts

    def pooled(self, buckets: np.ndarray, counts: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
        x, starts = self._vectors(buckets, counts)
        ends = starts + np.maximum(counts, 1)
        cuts = np.stack([starts, ends], axis=1).ravel()
        maps, tops = [], []
        for width, f, b in zip(WIDTHS, self.filters, self.biases):
            z = np.zeros((len(x), FILTERS), np.float32)
            n = len(x) - width + 1
            for i in range(width):
                z[:n] += x[i : i + n] @ f[i * DIMENSIONS : (i + 1) * DIMENSIONS]
            maps.append(z)
            tops.append(np.maximum.reduceat(z, cuts, axis=0)[::2] + b)
        return maps, tops, x, starts

    def logits(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(counts):
            return np.empty(0)
        _, tops, _, _ = self.pooled(buckets, counts)
        return np.maximum(np.concatenate(tops, axis=1), 0) @ self.weights + self.bias


def _step(value: np.ndarray, square: np.ndarray, slope: np.ndarray) -> None:
    square += slope * slope
    value -= RATE * slope / np.sqrt(square)


def fit(buckets: np.ndarray, counts: np.ndarray, label: np.ndarray, seed: int = 7) -> Model:
    """Trains on texts (their words' buckets back to back) with labels 0 and 1."""
    rng = np.random.default_rng(seed)
    model = Model(
        rng.normal(0, 0.05, (BUCKETS, DIMENSIONS)).astype(np.float32),
        [rng.normal(0, 0.2, (w * DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.2, FILTERS * len(WIDTHS)).astype(np.float32),
        0.0,
        np.zeros(len(FUNCTION_WORDS) + 1),
    )
    # dimension 0 starts as the smoothed log-odds of a bucket being in a toxic text
    share = label.mean()
    toxic, total = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for y, (own, n) in zip(np.split(label, range(256, len(label), 256)), _slices(buckets, counts)):
        doc = np.repeat(np.arange(len(n)), n * buckets.shape[1])
        seen = np.unique(doc * BUCKETS + own.ravel())  # a text counts once for a bucket
        toxic += np.bincount(seen % BUCKETS, y[seen // BUCKETS], BUCKETS)
        total += np.bincount(seen % BUCKETS, minlength=BUCKETS)
    odds = (toxic + 5 * share) / (total + 5)
    model.embedding[:, 0] = np.clip(np.log(odds / (1 - odds)) - np.log(share / (1 - share)), -1, 5) / 2
    model.filters[0][:, 0], model.weights[0] = 0, 1.0
    model.filters[0][0, 0] = 1.0
    squares = [np.full(BUCKETS, 1e-2, np.float32), [np.full_like(f, 1e-2) for f in model.filters], [np.full_like(b, 1e-2) for b in model.biases], np.full_like(model.weights, 1e-2), 1e-2]
    first = np.cumsum(counts) - counts
    for _ in range(EPOCHS):
        order = rng.permutation(len(counts))
        for a in range(0, len(order), BATCH):
            rows = order[a : a + BATCH]
            n = counts[rows]
            owner, place = spread(n)
            own = buckets[first[rows][owner] + place]
            maps, tops, x, starts = model.pooled(own, n)
            hidden = np.concatenate(tops, axis=1)
            active = np.maximum(hidden, 0)
            z = active @ model.weights + model.bias
            error = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[rows]) / len(rows)).astype(np.float32)
            slope_hidden = error[:, None] * model.weights * (hidden > 0)
            at, grads = [], []
            ends = starts + np.maximum(n, 1)
            text = np.repeat(np.arange(len(n)), n + PAD)
            inside = np.arange(len(x)) < ends[text]
            for j, (width, m) in enumerate(zip(WIDTHS, maps)):
                slope_f = np.zeros_like(model.filters[j])
                for k in range(FILTERS):
                    top = (tops[j][:, k] - model.biases[j][k])[text]
                    hit = np.flatnonzero((m[:, k] >= top) & inside)
                    _, one = np.unique(text[hit], return_index=True)
                    hit = hit[one]
                    g = slope_hidden[text[hit], j * FILTERS + k]
                    for i in range(width):
                        part = slice(i * DIMENSIONS, (i + 1) * DIMENSIONS)
                        where = np.minimum(hit + i, len(x) - 1)
                        slope_f[part, k] += g @ x[where]
                        word = where - starts[text[hit]]
                        real = (word < n[text[hit]]) & (g != 0)
                        at.append((np.cumsum(n) - n)[text[hit]][real] + word[real])
                        grads.append(g[real][:, None] * model.filters[j][part, k])
                _step(model.filters[j], squares[1][j], slope_f)
                _step(model.biases[j], squares[2][j], slope_hidden[:, j * FILTERS : (j + 1) * FILTERS].sum(axis=0))
            touched, grad = own[np.concatenate(at)].ravel(), np.repeat(np.concatenate(grads), buckets.shape[1], axis=0)
            ids, back = np.unique(touched, return_inverse=True)
            total_grad = np.stack([np.bincount(back, grad[:, d], len(ids)) for d in range(DIMENSIONS)], axis=1).astype(np.float32)
            squares[0][ids] += (total_grad**2).sum(axis=1)
            model.embedding[ids] -= RATE * total_grad / np.sqrt(squares[0][ids])[:, None]
            _step(model.weights, squares[3], active.T @ error)
            squares[4] += float(error.sum()) ** 2
            model.bias -= RATE * float(error.sum()) / np.sqrt(squares[4])
    return model


def best_threshold(logit: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    """The logit from which on to predict 1 for the best F1: midway between two rows."""
    order = np.argsort(-logit, kind="stable")
    z, y, w = logit[order], label[order], weight[order]
    hit, chosen = np.cumsum(y * w), np.cumsum(w)
    f1 = 2 * hit / (chosen + (y * w).sum())
    f1[:-1][z[:-1] == z[1:]] = -1
    k = int(f1.argmax())
    return float((z[k] + z[k + 1]) / 2) if k + 1 < len(z) else float(z[k])


def calibrate(model: Model, logit: np.ndarray, label: np.ndarray, weight: np.ndarray, language: np.ndarray) -> None:
    if not 0 < label.sum() < len(label):
        return
    common = best_threshold(logit, label, weight)
    model.thresholds[:] = common
    for k in range(len(FUNCTION_WORDS)):
        own = language == k
        n = label[own].sum()
        if 0 < n < own.sum():
            model.thresholds[k] = (n * best_threshold(logit[own], label[own], weight[own]) + SHRINK * common) / (n + SHRINK)


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, doc_id: str = "doc_id", text: str = "text") -> list[tuple]:
    """(doc_id, text, label, fold, rows of the label for each that is used), at most ``rows`` of a class."""
    marked = (
        labels.select(F.col("doc_id").alias("k"), F.col("toxic").cast("int").alias("y"))
        .where("k is not null and y in (0, 1)")
        .groupBy("k")
        .agg(F.max("y").alias("y"))
        .where(~held_out(F.col("k")))
    )
    found = dict(marked.groupBy("y").count().collect())
    chosen = [marked.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(rows) for y in (0, 1)]
    known = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t")).join(F.broadcast(chosen[0].union(chosen[1])), "k")
    own = known.groupBy("k", "y").agg(F.min("t").alias("t")).withColumn("fold", F.crc32(F.col("k").cast("string").cast("binary")) % 5)
    chosen = own.select("k", "t", "y", "fold").toArrow().sort_by("k")
    return [(k, t, y, fold, found[y] / min(found[y], rows)) for k, t, y, fold in zip(*chosen.to_pydict().values())]


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, doc_id: str = "doc_id", text: str = "text") -> Model | None:
    known = training_rows(docs, labels, rows, doc_id, text)
    label = np.array([x[2] for x in known], np.float64)
    if not 0 < label.sum() < len(label):
        return None
    parts, counts, language = [], [], []
    for i in range(0, len(known), 256):
        words = Words(pa.array([x[1] for x in known[i : i + 256]], pa.string()))
        parts.append(features(words))
        counts.append(words.counts)
        language.append(languages(words))
    fold, weight = np.array([x[3] for x in known]), np.array([x[4] for x in known])
    del known
    buckets, counts, language = np.concatenate(parts), np.concatenate(counts).astype(np.int64), np.concatenate(language)
    del parts
    used = fold != 1
    if not 0 < label[used].sum() < used.sum() or not 0 < label[~used].sum() < (~used).sum():
        used = np.ones(len(label), bool)  # too few rows for a fold of their own
    words_used = np.repeat(used, counts)
    model = fit(buckets[words_used], counts[used], label[used])
    seen = used if used.all() else ~used
    logit = np.concatenate([model.logits(b, c) for b, c in _slices(buckets[np.repeat(seen, counts)], counts[seen])])
    calibrate(model, logit, label[seen], weight[seen], language[seen])
    del buckets, words_used, logit
    pa.default_memory_pool().release_unused()  # the texts came through Arrow; a driver lives on after the fit
    return model


def _slices(buckets: np.ndarray, counts: np.ndarray, size: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ends = np.cumsum(counts)
    for i in range(0, len(counts), size):
        part = counts[i : i + size]
        yield buckets[ends[i] - counts[i] : ends[i + len(part) - 1]], part


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns to keep) and ``found`` (held_out, score, predicted)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(whole_row(docs, keep).alias("row"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).cast("string").alias("text"))
    out = given.select("row", F.lit(None).cast("struct<held_out:boolean,score:double,predicted:int>").alias("found")).schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, lambda x: x.column("text")):
            words = Words(batch.column("text"))
            scores = np.zeros(batch.num_rows)
            if held.value is not None:
                z = held.value.logits(features(words), words.counts) - held.value.thresholds[languages(words)]
                scores = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            found = pa.StructArray.from_arrays([batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=["held_out", "score", "predicted"])
            yield pa.RecordBatch.from_arrays([batch.column("row"), found], names=["row", "found"])

    return given.mapInArrow(task, out)
