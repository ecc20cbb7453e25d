"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated by temperature.

A text is a run of tokens: words, numbers and runs of signs, each followed by its shape (case or kind). Tokens are
hashed to ``BUCKETS`` words. Every word has a fixed sparse random index vector; its word vector is the sum of the index
vectors of its neighbours over all training texts, scaled to length one and added to its own index vector. The mean
and the spread of its token vectors and its repetition describe a document. A two-layer network in numpy turns that
into a log odds, which a temperature fitted on a part of its own makes a probability.

Tasks add up their neighbour sums before the shuffle; the table of word vectors has a fixed size. The network is
fitted on at most ``MAX_LABELLED`` labelled rows, those with the smallest hashes of their ids; everything else covers
all rows.

Defined cases: null and empty texts have zero vectors and get a score like any other; null ids and repeated rows are
rows like others; rows without a label are not learned from; with no or one kind of label the score is the share of
label 1, one half without any; texts are read whole, whatever their length; equal texts get equal scores, and a score of
just the limit counts as good; an empty table gives an empty result. Columns beyond the named ones are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paperwarden.operators.scale import Workspace

BUCKETS = 4_096
DIMS = 32
#: Entries of an index vector that are 1 or -1.
ENTRIES = 4
#: Neighbours to each side.
REACH = 2
#: Tokens handled at a time.
CHUNK = 200_000
MAX_LABELLED = 20_000
HIDDEN = 24
EPOCHS = 60
BATCH = 128
SEED = 7
POOLED = 2 * DIMS + 2

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of every bucket's index vector."""
    rng = np.random.default_rng(SEED)
    places = np.argsort(rng.random((BUCKETS, DIMS)), axis=1)[:, :ENTRIES]
    return places, rng.choice(np.array([-1, 1]), (BUCKETS, ENTRIES))


class TokenBuckets(dict):
    """Buckets of a token and of its shape; emptied before it grows large."""

    LIMIT = 300_000

    def __missing__(self, token: str) -> tuple[int, int]:
        if len(self) >= self.LIMIT:
            self.clear()
        if token[0].isalpha():
            shape = "upper" if token.isupper() and len(token) > 1 else "lower" if token.islower() else "title"
        elif token[0].isdigit():
            shape = f"digits {min(len(token), 8)}"
        else:
            shape = f"signs {token[:3]}"
        pair = self[token] = (zlib.crc32(token.lower().encode("utf-8", "surrogatepass")) % BUCKETS,
                              zlib.crc32(shape.encode("utf-8", "surrogatepass")) % BUCKETS)
        return pair


def token_buckets(text: str | None, known: TokenBuckets) -> np.ndarray:
    pairs = [known[t] for t in _TOKEN.findall(text or "")]
    return np.array(pairs, np.int64).ravel()


def neighbour_sums(texts: DataFrame) -> DataFrame:
    """Rows (bucket, d0, d1, ...): sums of the index vectors of neighbours, and the number of occurrences."""
    places, signs = index_vectors()
    names = [f"d{i}" for i in range(DIMS)]

    # A bucket beyond the last, without entries, stands between texts.
    places = np.vstack([places, np.zeros((1, ENTRIES), int)])
    signs = np.vstack([signs, np.zeros((1, ENTRIES), int)]).astype(float)
    between = np.full(REACH, BUCKETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenBuckets()
        sums = np.zeros((BUCKETS + 1) * DIMS)
        occurs = np.zeros(BUCKETS + 1)

        def add(whole: np.ndarray) -> None:
            nonlocal sums, occurs
            occurs += np.bincount(whole, minlength=BUCKETS + 1)
            for start in range(0, len(whole), CHUNK):
                for step in range(1, REACH + 1):
                    part = whole[start:start + CHUNK + step]
                    left, right = part[:-step], part[step:]
                    for a, b in ((left, right), (right, left)):
                        for e in range(ENTRIES):
                            sums += np.bincount(a * DIMS + places[b, e], signs[b, e], len(sums))

        held: list[np.ndarray] = []
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held += [token_buckets(text, known), between]
                if sum(map(len, held[-2:])) >= CHUNK or len(held) >= 400:
                    add(np.concatenate(held))
                    held = []
        if held:
            add(np.concatenate(held))
        sums, occurs = sums[:-DIMS], occurs[:-1]
        used = np.flatnonzero(occurs)
        table = sums.reshape(BUCKETS, DIMS)[used].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(occurs[used].astype(np.int64)), *(pa.array(table[:, i]) for i in range(DIMS))],
            names=["bucket", "occurs", *names])

    rows = texts.mapInArrow(run, "bucket bigint, occurs bigint, " + ", ".join(f"{n} bigint" for n in names))
    return rows.groupBy("bucket").agg(F.sum("occurs").alias("occurs"), *[F.sum(n).alias(n) for n in names])


def word_vectors(texts: DataFrame) -> np.ndarray:
    """A vector for every bucket, from all of ``texts``; the table has a fixed size."""
    found = neighbour_sums(texts).toPandas()
    places, signs = index_vectors()
    own = np.zeros((BUCKETS, DIMS))
    np.put_along_axis(own, places, signs / np.sqrt(ENTRIES), axis=1)
    context = np.zeros((BUCKETS, DIMS))
    context[found["bucket"].to_numpy(dtype=int)] = found[[f"d{i}" for i in range(DIMS)]].to_numpy(dtype=float)
    length = np.linalg.norm(context, axis=1, keepdims=True)
    return own + np.divide(context, length, out=np.zeros_like(context), where=length > 0)


def pooled(text: str | None, vectors: np.ndarray, known: TokenBuckets) -> np.ndarray:
    """Mean and spread of the token vectors, share of tokens that are new in the text, and log length."""
    buckets = token_buckets(text, known)
    if not len(buckets):
        return np.zeros(POOLED)
    counts = np.bincount(buckets, minlength=BUCKETS)
    used = np.flatnonzero(counts)
    weight = counts[used] / len(buckets)
    mean = weight @ vectors[used]
    spread = np.sqrt(np.maximum(weight @ vectors[used] ** 2 - mean ** 2, 0))
    return np.concatenate([mean, spread, [len(used) / len(buckets) ** 0.5, np.log1p(len(buckets))]])


def pooled_vectors(docs: DataFrame, id_col: str, text_col: str, vectors: np.ndarray) -> DataFrame:
    """Rows (doc_id, vector)."""
    picked = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = TokenBuckets(), shared.value
        for batch in batches:
            made = [pooled(text, table, known).astype(np.float32).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["doc_id", "vector"])

    return picked.mapInArrow(run, f"doc_id {picked.schema[0].dataType.simpleString()}, vector binary")


@dataclass
class Network:
    """Standardised input, one hidden layer, log odds, temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x) / self.temperature, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Network:
    """Adam on the cross-entropy of four fifths of the rows; the temperature is fitted on the rest."""
    width = x.shape[1]
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        odds = np.log((share + 1e-6) / (1 - share + 1e-6))
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), odds, 1.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    apart = order[: len(y) // 5] if len(y) >= 50 else order
    learn = order[len(y) // 5:] if len(y) >= 50 else order
    mean, scale = x[learn].mean(axis=0), x[learn].std(axis=0) + 1e-3
    net = Network(mean, scale, rng.normal(0, np.sqrt(2 / width), (width, HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), 0.0, 1.0)
    z = (x - mean) / scale
    values = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(EPOCHS):
        for start in range(0, len(learn), BATCH):
            rows = rng.choice(learn, min(BATCH, len(learn)), replace=False)
            w1, b1, w2, b2 = values
            inner = z[rows] @ w1 + b1
            hidden = np.maximum(inner, 0)
            error = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2[0], -40, 40))) - y[rows]) / len(rows)
            back = np.outer(error, w2) * (inner > 0)
            slopes = [z[rows].T @ back + 1e-4 * w1, back.sum(axis=0), hidden.T @ error + 1e-4 * w2,
                      np.array([error.sum()])]
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope ** 2
                values[i] = values[i] - 0.003 * (first[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = values[0], values[1], values[2], float(values[3][0])
    odds = net.log_odds(x[apart])
    tried = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    loss = [np.mean(np.logaddexp(0, -np.where(y[apart] == 1, 1, -1) * odds / t)) for t in tried]
    net.temperature = float(tried[int(np.argmin(loss))])
    return net


def score_quality(docs: DataFrame, labels: DataFrame, learnable, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Id and ``score`` of every row of ``docs``; only rows where ``learnable`` holds are learned from."""
    work = Workspace(docs.sparkSession)
    vectors = word_vectors(docs.where(learnable).select(docs[text_col].alias("text")))
    table = work.table(pooled_vectors(docs, id_col, text_col, vectors))
    known = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("label")).where(
        F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    allowed = docs.where(learnable).select(docs[id_col].alias("doc_id")).distinct()
    taken = work.table(known.join(allowed, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    sample = table.join(taken, "doc_id").groupBy("doc_id").agg(
        F.min("vector").alias("vector"), F.max("label").alias("label")).orderBy("doc_id").toPandas()
    x = np.stack([np.frombuffer(v, np.float32) for v in sample["vector"]]).astype(float) if len(sample) else np.zeros((0, POOLED))
    net = fit_network(x, sample["label"].to_numpy(dtype=float))
    parts = docs.sparkSession.sparkContext.broadcast(
        (net.mean, net.scale, net.w1, net.b1, net.w2, net.b2, net.temperature))
    kind = table.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Network(*parts.value)
        for batch in batches:
            if batch.num_rows:
                rows = np.stack([np.frombuffer(v, np.float32) for v in batch.column(1).to_pylist()]).astype(float)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fitted.probability(rows))],
                                                 names=["doc_id", "score"])

    scored = table.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(F.col("doc_id").alias(id_col), "score")
