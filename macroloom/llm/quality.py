"""Quality of documents from learned vectors of hashed words and character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.llm.common import portions, stored

#: Labelled documents of a class that the vectors are fitted on (in expectation, where there are more). All labelled rows count for the priors.
SAMPLE = 3000
#: Vectors of the model and their length.
BUCKETS, DIM = 1 << 16, 16
#: Lengths of character n-grams, in bytes. Their first and last byte may be the space around a word.
GRAMS = (3, 4, 5)
#: Turns of the descent over the sample, and its first step.
EPOCHS, RATE = 4, 0.3

#: Odd base of the rolling sums, and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class Model:
    """``classes`` in order, a vector a bucket, the output layer, and the logarithms of the classes' shares."""

    classes: list[int]
    vectors: np.ndarray
    output: np.ndarray
    prior: np.ndarray


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _bucket(x: np.ndarray, kind: int) -> np.ndarray:
    """Hashes of features of a kind as bucket numbers."""
    x = (x + np.uint64(kind)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    return (x >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int32)


def features(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, share) of every feature: words, pairs of words, and character n-grams of words.

    Words are what stands between ASCII white space, as they are written. A pair of equal words is
    one feature whatever the word is. The words of a text together, its pairs and its n-grams weigh
    a third each.
    """
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    space = _SPACE[data]
    data = np.where(space, np.uint8(0x20), data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=sums[1:])
    back = _powers(_INVERSE, len(data))
    first = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    after = np.flatnonzero(~space[:-1] & space[1:]) + 1
    words = (sums[after] - sums[first]) * back[first]
    owner = np.searchsorted(ends, first, "right")
    pairs = np.where(words[1:] == words[:-1], np.uint64(0), words[1:] * np.uint64(3) + words[:-1])
    within = owner[1:] == owner[:-1]
    texts_of = [owner, owner[1:][within]]
    found = [_bucket(words, 1), _bucket(pairs[within], 2)]
    grams = []
    for n in GRAMS:
        if len(data) < n:
            grams.append(np.zeros(0, np.int64))
            continue
        at = ~space[1 : len(data) - n + 2]
        for i in range(2, n - 1):
            at = at & ~space[i : len(data) - n + 1 + i]
        at = np.flatnonzero(at[: len(data) - n + 1])
        found.append(_bucket((sums[at + n] - sums[at]) * back[at], n))
        grams.append(np.searchsorted(ends, at + 1, "right"))
    texts_of.append(np.concatenate(grams))
    shares = [(1 / 3 / np.maximum(np.bincount(t, minlength=len(texts)), 1))[t] for t in texts_of]
    return np.concatenate(texts_of), np.concatenate(found), np.concatenate(shares)


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) to (label, buckets, shares): each bucket of a text once."""
    for batch in portions(batches, 1):
        texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
        text, bucket, share = features(texts)
        keys, at = np.unique(text.astype(np.int64) * BUCKETS + bucket, return_inverse=True)
        shares = np.bincount(at, share, len(keys)).astype(np.float32)
        offsets = np.searchsorted(keys, np.arange(len(texts) + 1) * BUCKETS).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in ((keys % BUCKETS).astype(np.int32), shares)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["label", "buckets", "shares"])


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(-1, keepdims=True))
    return x / x.sum(-1, keepdims=True)


def descend(labels: np.ndarray, n_classes: int, buckets: list[np.ndarray], shares: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and output layer after stochastic gradient descent, one document a step.

    Classes weigh the same, however often they are in the sample. Steps shrink with the squared
    gradients that a vector has had.
    """
    rng = np.random.default_rng(11)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    output = np.zeros((DIM + 1, n_classes), np.float32)
    seen, seen_output = np.full(BUCKETS, 1e-8, np.float32), np.full(output.shape, 1e-8, np.float32)
    weight = len(labels) / np.maximum(np.bincount(labels, minlength=n_classes), 1) / n_classes
    for epoch in range(EPOCHS):
        rate = np.float32(RATE * (1 - epoch / EPOCHS))
        for i in rng.permutation(len(labels)).tolist():
            rows, share, label = buckets[i], shares[i], labels[i]
            hidden = np.append(share @ vectors[rows], np.float32(1))
            error = _softmax(hidden @ output)
            error[label] -= 1
            error *= np.float32(weight[label])
            change, inner = np.outer(hidden, error), output[:DIM] @ error
            # A feature's gradient is its share of the document times ``inner``; steps are in shares' own unit.
            seen[rows] += share * share * (inner @ inner)
            vectors[rows] -= rate * (share / np.sqrt(seen[rows]))[:, None] * inner
            seen_output += change * change
            output -= rate * change / np.sqrt(seen_output)
    return vectors, output


def fit(table: pa.Table) -> pa.Table:
    """The sampled rows (label, buckets, shares) as one row: classes, vectors and output layer."""
    table = table.combine_chunks().sort_by("label")
    classes, labels = np.unique(table.column("label").to_numpy(), return_inverse=True)

    def split(name):
        column = table.column(name).combine_chunks()
        return np.split(column.flatten().to_numpy(), column.offsets.to_numpy()[1:-1] - column.offsets[0].as_py())

    buckets, shares = split("buckets"), split("shares")
    order = sorted(range(len(labels)), key=lambda i: (labels[i], buckets[i].tobytes(), shares[i].tobytes()))  # whatever order rows came in
    vectors, output = descend(labels[order], len(classes), [buckets[i] for i in order], [shares[i] for i in order])
    return pa.table({"classes": [classes.tolist()], "vectors": [vectors.tobytes()], "output": [output.tobytes()]})


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", sample: int = SAMPLE) -> Model | None:
    """The model of ``labels`` (id, label: whole numbers); None if no document has a label.

    Of each class about ``sample`` rows are fitted on, whole texts: those whose hash lies below the
    share that gives this number. They are chosen by
    ids alone, so texts of other documents are neither shuffled nor gathered. Features are counted
    in the tasks that read the texts; one task descends, and what leaves it is the model. A class's
    share counts all labelled rows. Null labels and ids, and ids without a document, count for
    nothing; a document that is labelled twice counts twice.
    """
    marked = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("long").alias("label")).where("id is not null and label is not null")
    marked = marked.join(docs.select(F.col(id_column).alias("id")).distinct(), "id", "left_semi")
    marked = stored(marked, "quality-labels")
    sizes = stored(marked.groupBy("label").agg(F.count("*").alias("n")), "quality-sizes")
    shares = {r["label"]: r["n"] for r in sizes.collect()}
    if not shares:
        return None
    low = F.pmod(F.xxhash64("id"), F.lit(1 << 32)) / (1 << 32) < F.lit(sample) / F.col("n")
    chosen = stored(marked.join(sizes, "label").where(low).select("id", "label"), "quality-sample")
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    counted = texts.join(chosen, "id").select("label", "text").mapInArrow(count_batches, "label long, buckets array<int>, shares array<float>")
    made = counted.groupBy().applyInArrow(fit, "classes array<long>, vectors binary, output binary").collect()[0]
    output = np.frombuffer(made.output, np.float32).reshape(DIM + 1, -1)
    prior = np.log([shares[c] / sum(shares.values()) * len(shares) for c in made.classes])
    return Model(list(made.classes), np.frombuffer(made.vectors, np.float32).reshape(BUCKETS, DIM), output, prior)


def score_texts(model: Model, texts: Sequence[bytes]) -> np.ndarray:
    """Probability of every class for every text, the shares of classes counted in.

    The output layer is linear, so the layer of the averaged vector is the average of the layers of
    the vectors: one number a bucket and class is looked up instead of a vector.
    """
    layers = model.vectors.astype(np.float64) @ model.output[:DIM].astype(np.float64)
    return _scored(layers, model.output[DIM].astype(np.float64) + model.prior, texts)


def _scored(layers: np.ndarray, bias: np.ndarray, texts: Sequence[bytes]) -> np.ndarray:
    text, bucket, share = features(texts)
    means = [np.bincount(text, layers[bucket, c] * share, len(texts)) for c in range(layers.shape[1])]
    return _softmax(np.stack(means, 1) + bias)


def score_quality(docs: DataFrame, model: Model | None, target: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score) of every document: the probability that its label is ``target``.

    Null texts are empty; a text without words gets the share of the class among the labels.
    Repeated rows are scored alike. Without a model every score is 0.5; a class that no label names
    has probability 0. Other columns are ignored.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    if model is None:
        return rows.select(F.col("id").alias(id_column), F.lit(0.5).alias("score"))
    if target not in model.classes:
        return rows.select(F.col("id").alias(id_column), F.lit(0.0).alias("score"))
    at = model.classes.index(target)
    layers = model.vectors.astype(np.float64) @ model.output[:DIM].astype(np.float64)
    shared = docs.sparkSession.sparkContext.broadcast((layers, model.output[DIM].astype(np.float64) + model.prior))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layers, bias = shared.value
        for batch in portions(batches, 1):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scored(layers, bias, texts)[:, at])], names=["id", "score"])

    kind = dict(docs.dtypes)[id_column]
    return rows.mapInArrow(score, f"id {kind}, score double").withColumnRenamed("id", id_column)
