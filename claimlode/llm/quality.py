"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. The model weighs a line's own features and those of the lines around it,
and how likely a label follows another. A document's score is the mean of its lines' forward-backward
marginals, weighted by length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlode.llm.common import slices, utf8, word_borders, word_hashes

#: The model is fitted on at most so many labelled documents, those with the smallest id hashes.
SAMPLE_DOCS = 6000
#: In training, longer documents count as several chains of this many lines.
CHAIN = 64
ROUNDS, RATE, PENALTY = 150, 0.1, 1e-3
OWN_FEATURES = 17
#: Bytes of text whose lines are weighed together, and, as features need many times a text's memory, those whose
#: features are taken at once. A longer text is not cut.
_SLICE, _PIECE = 2 << 20, 1 << 18


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    follow: np.ndarray  # [label, next label]
    prior: float


def line_table(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of texts that hold more than white space: own features, bytes, and the row of each."""
    data, offsets = utf8(column)
    newline = np.flatnonzero(data == 10)
    border = np.unique(np.concatenate((offsets, newline + 1)))
    begin, end = border[:-1], border[1:]
    starts, ends, _ = word_borders(data, offsets)
    line = np.searchsorted(begin, starts, side="right") - 1
    words = np.bincount(line, minlength=len(begin))
    kept = np.flatnonzero(words)
    renumber = np.cumsum(words > 0) - 1
    line, words, begin, end = renumber[line], words[kept].astype(float), begin[kept], end[kept]
    n = len(kept)
    size = (end - begin).astype(float)

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return (sums[end] - sums[begin]).astype(float)

    def per_line(mask: np.ndarray) -> np.ndarray:
        return np.bincount(line, mask, minlength=n) / words

    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    digit = (data >= 48) & (data <= 57)
    wide = data >= 128
    stop = np.isin(data, np.frombuffer(b".,;:?'\"()-", np.uint8))
    blank = data <= 32
    sign = ~(upper | lower | digit | wide | stop | blank)
    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & ~blank[1:]
    hashes = word_hashes(data, starts, ends)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((hashes, line))
    known = np.zeros(len(hashes), bool)
    known[1:] = (hashes[order][1:] == hashes[order][:-1]) & (line[order][1:] == line[order][:-1])
    length = (ends - starts).astype(float)
    letters = np.maximum(total(upper | lower), 1)
    row = np.searchsorted(offsets, begin, side="right") - 1
    digest = np.zeros(n, np.uint64)
    np.add.at(digest, line, hashes)
    by_row = np.lexsort((digest, row))
    copy = np.zeros(n)
    twin = (digest[by_row][1:] == digest[by_row][:-1]) & (row[by_row][1:] == row[by_row][:-1])
    copy[by_row[1:][twin]] = 1
    last = data[ends[np.searchsorted(line, np.arange(n), side="right") - 1] - 1] if n else np.zeros(0, np.uint8)
    features = np.stack(
        [
            np.log1p(size),
            np.log1p(words),
            per_line(length),
            per_line(length**2) - per_line(length) ** 2,
            per_line(length == 1),
            total(upper) / letters,
            total(digit) / size,
            total(stop) / size,
            total(sign) / size,
            np.log1p(total(sign)),
            total(wide) / size,
            total(same) / size,
            per_line(again),
            np.bincount(line[order], known, minlength=n) / words,
            per_line(sign[ends - 1]),
            copy,
            np.isin(last, np.frombuffer(b".!?", np.uint8)).astype(float),
        ],
        axis=1,
    ) if n else np.zeros((0, OWN_FEATURES))
    return features, size, row


def with_neighbours(features: np.ndarray, row: np.ndarray) -> np.ndarray:
    """A line's features, those of the line before and after it, and whether there is one."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    joined = (row[1:] == row[:-1])[:, None]
    before[1:] = np.where(joined, features[:-1], 0)
    after[:-1] = np.where(joined, features[1:], 0)
    edge = np.zeros((len(row), 2))
    edge[1:, :1], edge[:-1, 1:] = joined, joined
    return np.concatenate((features, before, after, edge), axis=1)


def marginals(emit: np.ndarray, chain: np.ndarray, follow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line by forward-backward, and the expected label pairs summed up.

    ``emit`` is the log odds of good for each line; lines of one chain lie together.
    """
    if not len(chain):
        return np.zeros(0), np.zeros((2, 2))
    first = np.flatnonzero(np.concatenate(([True], chain[1:] != chain[:-1])))
    sizes = np.diff(np.append(first, len(chain)))
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # chains longer than t
    odds = np.clip(emit, -30, 30)
    local = np.stack((1 / (1 + np.exp(odds)), 1 / (1 + np.exp(-odds))), axis=1)
    step = np.exp(follow - follow.max())
    forward, backward = np.empty_like(local), np.ones_like(local)
    state = local[first]
    forward[first] = state / state.sum(1, keepdims=True)
    for t in range(1, sizes[0]):
        at = first[: active[t]] + t
        state = (forward[at - 1] @ step) * local[at]
        forward[at] = state / state.sum(1, keepdims=True)
    for t in range(sizes[0] - 2, -1, -1):
        at = first[: active[t + 1]] + t
        state = (backward[at + 1] * local[at + 1]) @ step.T
        backward[at] = state / state.sum(1, keepdims=True)
    both = forward * backward
    good = both[:, 1] / both.sum(1)
    inner = np.flatnonzero(chain[1:] == chain[:-1])
    pair = forward[inner][:, :, None] * step * (local[inner + 1] * backward[inner + 1])[:, None, :]
    return good, (pair / pair.sum((1, 2), keepdims=True)).sum(0)


def fit(features: np.ndarray, size: np.ndarray, doc: np.ndarray, label: np.ndarray) -> Model:
    """Maximum likelihood with every line labelled as its document; Adam on all lines at once."""
    place = np.arange(len(doc)) - np.searchsorted(doc, doc)
    chain = np.cumsum(np.concatenate(([True], (doc[1:] != doc[:-1]) | (place[1:] % CHAIN == 0))))
    mean, spread = features.mean(0), np.maximum(features.std(0), 1e-6)
    x = np.clip((features - mean) / spread, -6, 6)
    inner = np.flatnonzero(chain[1:] == chain[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[inner], label[inner + 1]), 1)
    theta = np.zeros(x.shape[1] + 5)
    speed, power = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, ROUNDS + 1):
        w, bias, follow = theta[:-5], theta[-5], theta[-4:].reshape(2, 2)
        good, pairs = marginals(x @ w + bias, chain, follow)
        gap = label - good
        slope = np.concatenate((x.T @ gap, [gap.sum()], (seen - pairs).ravel())) / len(doc) - PENALTY * theta
        speed, power = 0.9 * speed + 0.1 * slope, 0.99 * power + 0.01 * slope**2
        theta = theta + RATE * (speed / (1 - 0.9**t)) / (np.sqrt(power / (1 - 0.99**t)) + 1e-8)
    prior = float(np.bincount(doc, label)[np.unique(doc)].astype(bool).mean())
    return Model(mean, spread, theta[:-5], float(theta[-5]), theta[-4:].reshape(2, 2), prior)


def in_training(doc_id: Column) -> Column:
    """Whether labels of a document may be learned; the others are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit the model on a bounded sample of labelled documents; None where there is no usable label.

    Only line features of the sample reach the driver, never texts.
    """
    known = labels.where(in_training(F.col("doc_id")) & F.col("quality").isin(0, 1))
    chosen = (
        known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most SAMPLE_DOCS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _PIECE):
                features, size, row = line_table(part.column("text"))
                wide = with_neighbours(features, row).astype(np.float32)
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id").take(pa.array(row)),
                        "label": part.column("quality").take(pa.array(row)),
                        "size": pa.array(size),
                        "features": pa.array([x.tobytes() for x in wide], pa.binary()),
                    }
                )

    lines = sample.mapInArrow(run, "doc_id long, label int, size double, features binary").toArrow()
    if not lines.num_rows:
        return None
    # a document's lines come from one task, in order
    doc = np.unique(lines.column("doc_id").to_numpy(), return_inverse=True)[1]
    order = np.argsort(doc, kind="stable")
    features = np.frombuffer(b"".join(lines.column("features").to_pylist()), np.float32).reshape(len(doc), -1)
    label = lines.column("label").to_numpy()
    return fit(features[order].astype(float), lines.column("size").to_numpy()[order], doc[order], label[order])


def line_odds(batch: pa.RecordBatch, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, row and log odds of good of every line of the texts, whose features are taken piece by piece."""
    lines, begin = [], 0
    for piece in slices(batch, "text", _PIECE):
        features, size, row = line_table(piece.column("text"))
        x = np.clip((with_neighbours(features, row) - model.mean) / model.spread, -6, 6)
        lines.append((size, row + begin, x @ model.weights + model.bias))
        begin += piece.num_rows
    return tuple(np.concatenate(column) for column in zip(*lines, strict=True))


def scorer(model: Model | None):
    """A column function: text to score. A text without words gets the share of good documents."""

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        out = [pa.array([], pa.float64())]
        for part in slices(pa.record_batch([text], names=["text"]), "text", _SLICE):
            n = part.num_rows
            result = np.full(n, 0.5 if model is None else model.prior)
            if model is not None:
                size, row, emit = line_odds(part, model)
                good, _ = marginals(emit, row, model.follow)
                weight = np.bincount(row, size, minlength=n)
                mean = np.bincount(row, good * size, minlength=n) / np.maximum(weight, 1e-9)
                result = np.where(weight > 0, mean, result)
            out.append(pa.array(result))
        return pa.concat_arrays(out)

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of (doc_id, text).

    Only the text decides. Null and empty texts get the training share of good documents. Repeated
    rows are scored alike; a null doc_id is scored and not held out; other columns are ignored.
    Without usable labels every score is 0.5.
    """
    score = scorer(learn(docs, labels))
    scored = docs.select(
        "doc_id", F.coalesce(~in_training(F.col("doc_id")), F.lit(False)).alias("held_out"), score("text").alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject: those with a score of at least 0.5.

    Null and empty texts, repeated rows and a table of labels without use are scored as in ``score_documents``.
    """
    score = scorer(learn(docs, labels))
    return docs.where(score("text") >= 0.5)
