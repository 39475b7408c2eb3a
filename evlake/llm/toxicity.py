"""Toxicity by a classifier chain.

The label columns are predicted one after the other. Each has a linear model over word
features and over the probabilities of the labels before it. While fitting, those
probabilities are out of fold (the model that gave them has not seen the row), so a
later model learns how far an earlier one can be trusted; when scoring, the final
earlier models give them. The last label decides.

The models are fitted on at most ``SAMPLE`` distinct labelled texts, the first by a hash
of id and text: a bound whatever the number of labels, documented here as a parameter.
Copies and labels without a document take no place in it. Their texts are found with a
broadcast of these keys. Scoring reads every text in whole
and shuffles nothing; features are whether and how often a word occurs, for every word and
word beginning that tells a label apart by a chi-square of ``LEVEL`` or more. Each label
has its own, and their number is not bounded, so neither a common label nor the many
inflections of one stem displace a rare language's words. A beginning stands for all
inflections of a stem. Words are runs of letters, A-Z as a-z.

Defined results: a null or blank text has no features and gets the models' base
rates; null labels count as 0, and an id labelled several times has a label if any
of them says so; equal texts have the labels of the first of their ids by hash; labels of
unknown documents are ignored; without any labelled row of both kinds nothing is toxic.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evlake.llm.arrays import LETTERS, slices, texts_of, words_of
from evlake.llm.common import stored, with_lookup

SAMPLE = 8192
#: Chi-square (one degree of freedom) from which on a word counts as telling; chance
#: alone reaches it for one word in 10,000.
LEVEL = 15.0
#: Bytes of the word beginnings.
HEADS = (4, 5, 6)
FOLDS = 5
#: A word is a feature only if so many of the sample's rows have it.
LEAST_ROWS = 5
RIDGE = 1e-3
STEPS = 12
#: Steps of conjugate gradients within a Newton step.
INNER = 40


def _marks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and hash of every word, and of the beginnings of every longer word."""
    found = words_of(*texts_of(batch.column("text")), LETTERS)
    row = np.repeat(np.arange(batch.num_rows), np.diff(found.first))
    yield row, _short(found.hashes)
    for size in HEADS:
        which, hashes = found.heads(size)
        yield row[which], _short(hashes)


def _short(hashes: np.ndarray) -> np.ndarray:
    """32 bits tell the few features from other words well enough, in half the memory."""
    return (hashes >> np.uint64(32)).astype(np.uint32)


@dataclass
class Marked:
    """Values of the features that rows have, as entries; all other values are 0."""

    rows: int
    width: int
    row: np.ndarray
    column: np.ndarray
    value: np.ndarray

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], self.rows)

    def back(self, u: np.ndarray, power: int = 1) -> np.ndarray:
        return np.bincount(self.column, self.value**power * u[self.row], self.width)


@dataclass
class Chain:
    """Feature words by hash, and for each label the weights and the constant."""

    words: np.ndarray
    labels: list[str]
    weights: list[np.ndarray]
    threshold: float = 0.5

    def features(self, batch: pa.RecordBatch) -> Marked:
        # Most words are no feature; a table of the hashes' first bits says so at once.
        maybe = np.zeros(1 << 16, bool)
        maybe[self.words >> np.uint32(16)] = True
        found, width = [], len(self.words)
        for row, hashes in _marks(batch):
            here = np.flatnonzero(maybe[hashes >> np.uint32(16)])
            at = np.searchsorted(self.words, hashes[here])
            at[at == width] = 0
            hit = self.words[at] == hashes[here] if len(here) else here
            found.append(row[here[hit]] * np.int64(width) + at[hit])
        places, times = np.unique(np.concatenate(found), return_counts=True)
        row, column = np.divmod(places, max(width, 1))
        return Marked(batch.num_rows, width, row, column, 1 - np.exp2(-times.astype(np.float64)))

    def probabilities(self, x: Marked) -> np.ndarray:
        """Rows by labels; every label sees those before it."""
        out = np.zeros((x.rows, len(self.weights)))
        for i, w in enumerate(self.weights):
            out[:, i] = _probability(x, out[:, :i], w)
        return out


def _probability(x: Marked, seen: np.ndarray, w: np.ndarray) -> np.ndarray:
    return _sigmoid(x.times(w[: x.width]) + seen @ w[x.width : -1] + w[-1])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit(x: Marked, seen: np.ndarray, y: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Ridge logistic regression over the ``used`` rows by Newton steps, each solved by
    conjugate gradients, so that no matrix of the features is made; both classes weigh
    the same, however rare one is."""
    n = max(1, int(used.sum()))
    share = np.clip(y[used].mean() if used.any() else 0.5, 1 / (n + 1), n / (n + 1))
    weight = used * np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) / n
    ridge = np.full(x.width + seen.shape[1] + 1, RIDGE)
    ridge[-1] = 1e-9
    w = np.zeros(len(ridge))

    def back(u: np.ndarray, power: int = 1) -> np.ndarray:
        return np.concatenate((x.back(u, power), (seen**power).T @ u, [u.sum()]))

    for _ in range(STEPS):
        p = _probability(x, seen, w)
        curve = weight * p * (1 - p) + used * 1e-9
        left = back(weight * (p - y)) + ridge * w
        scale = back(curve, 2) + ridge
        step, enough = np.zeros(len(w)), 3e-2 * np.sqrt(left @ (left / scale))
        toward = left / scale
        gain = left @ toward
        for _ in range(INNER):
            if np.sqrt(gain) <= enough:
                break
            along = x.times(toward[: x.width]) + seen @ toward[x.width : -1] + toward[-1]
            bent = back(curve * along) + ridge * toward
            far = gain / (toward @ bent)
            step += far * toward
            left = left - far * bent
            before, gain = gain, left @ (left / scale)
            toward = left / scale + gain / before * toward
        w = w - step
        if np.abs(step).max() < 1e-2:
            break
    return w


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct word hashes of each text, next to the other columns; a text once in a
    task. There are at most ``SAMPLE`` texts."""
    seen = set()
    for whole_batch in batches:
        for part in slices(whole_batch, "text"):
            known = part.column("text_hash").to_pylist()
            new = [i for i, h in enumerate(known) if h not in seen and not seen.add(h)]
            if not new:
                continue
            batch = part.take(pa.array(new, pa.int64()))
            row, hashes = (np.concatenate(x) for x in zip(*_marks(batch), strict=True))
            order = np.argsort(row, kind="stable")
            first = np.searchsorted(row[order], np.arange(batch.num_rows + 1))
            hashes = hashes[order]
            own = [np.unique(hashes[a:b]).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            others = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(own, pa.binary())], [*others, "hashes"]
            )


def _sample(texts: DataFrame, labels: DataFrame, names: list[str]) -> DataFrame:
    """Keys and labels of the distinct labelled texts that the models are fitted on."""
    held = [f"label_{i}" for i in range(len(names))]
    marked = [F.max(F.coalesce((F.col(c) > 0).cast("int"), F.lit(0))).alias(h) for c, h in zip(names, held, strict=True)]
    known = labels.withColumn("doc_id", F.col("doc_id").cast("long")).where("doc_id is not null").groupBy("doc_id").agg(*marked)
    each = stored(texts.select("doc_id", "text_hash").where("doc_id is not null").distinct(), "text-keys")
    known = known.join(each.groupBy("doc_id").agg(F.count("*").alias("n")), "doc_id")
    found = with_lookup(each, known, ["doc_id"], "n", each.count())
    first = F.min(F.struct(F.xxhash64("doc_id", "text_hash").alias("place"), "doc_id", *held)).alias("first")
    return (
        found.groupBy("text_hash").agg(first).select("text_hash", "first.*")
        .orderBy("place", "text_hash").limit(SAMPLE).select("doc_id", "text_hash", *held)
    )


def fit(docs: DataFrame, labels: DataFrame, names: list[str], id_column: str = "doc_id", text_column: str = "text") -> Chain:
    """The chain over the label columns ``names``, in this order."""
    own = F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("text_hash")
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), own, F.col(text_column).alias("text"))
    # At most SAMPLE rows of a few numbers are broadcast.
    rows = texts.join(F.broadcast(stored(_sample(texts, labels, names), "sample")), ["doc_id", "text_hash"])
    held = [f"label_{i}" for i in range(len(names))]
    numbers = ", ".join(f"{h} int" for h in held)
    found = rows.select("doc_id", *held, "text_hash", "text").mapInArrow(
        _hashes, f"doc_id long, {numbers}, text_hash long, hashes binary"
    )
    sample = found.dropDuplicates(["text_hash"]).toArrow().sort_by([("doc_id", "ascending"), ("text_hash", "ascending")])
    sets = [np.frombuffer(b, np.uint32) for b in sample.column("hashes").to_pylist()]
    y = np.column_stack([sample.column(h).to_numpy() for h in held]).astype(np.float32)
    fold = sample.column("doc_id").to_numpy() * 2654435761 % 2**32 * FOLDS // 2**32
    words, x = _choose(sets, y)
    weights, seen = [], np.zeros((x.rows, 0))
    for i in range(len(names)):
        apart = np.zeros(x.rows)
        for k in range(FOLDS):
            rest = fold != k
            apart[~rest] = _probability(x, seen, _fit(x, seen, y[:, i], rest))[~rest]
        weights.append(_fit(x, seen, y[:, i], np.ones(x.rows, bool)))
        seen = np.column_stack((seen, apart))
    return Chain(words, names, weights, _threshold(seen[:, -1], y[:, -1]))


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut of the out-of-fold probabilities with the best F1, in the middle of the
    gap it falls into; above 1 if the labels have only one kind or no cut is better than
    rejecting everything."""
    if not len(y) or y.min() == y.max():
        return 2.0
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order])
    f1 = 2 * right / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(p[order][1:] < p[order][:-1], True)  # equal ones go together
    best = int(np.argmax(np.where(last, f1, -1)))
    if f1[best] <= f1[-1]:
        return 2.0
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float((p[order][best] + below) / 2)


def _choose(sets: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, Marked]:
    """Every word that tells a label by the chi-square of its rows, and the rows' features."""
    words, rows = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint32), return_counts=True)
    words, rows = words[rows >= LEAST_ROWS], rows[rows >= LEAST_ROWS]
    telling = np.zeros(len(words), bool)
    for i in range(y.shape[1]):
        base = y[:, i].mean() if len(y) else 0
        own = [sets[k] for k in np.flatnonzero(y[:, i])]
        known = _places(words, np.concatenate(own)) if own else np.zeros(0, np.int64)
        with_label = np.bincount(known, minlength=len(words))
        telling |= (with_label - rows * base) ** 2 >= LEVEL * np.maximum(1e-9, rows * base * (1 - base))
    chosen = words[telling]
    found = [_places(chosen, s) for s in sets]
    row = np.repeat(np.arange(len(sets)), [len(f) for f in found])
    column = np.concatenate(found) if found else np.zeros(0, np.int64)
    # In the sample a word counts as there or not; a single use has feature 1/2.
    return chosen, Marked(len(sets), len(chosen), row, column, np.full(len(row), 0.5))


def _places(words: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Places in the sorted ``words`` of those in ``found`` that are there."""
    at = np.searchsorted(words, found)
    at = np.minimum(at, max(len(words) - 1, 0))
    return at[words[at] == found] if len(words) else at[:0]


def _score(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in slices(whole_batch, "text"):
                p = chain.probabilities(chain.features(batch))
                columns = [pa.array(p[:, i].astype(np.float64)) for i in range(len(chain.labels))]
                toxic = pa.array(p[:, -1] >= chain.threshold)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *columns, toxic], ["doc_id", *[f"p_{c}" for c in chain.labels], "rejected"]
                )

    return run


def scores(docs: DataFrame, chain: Chain, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document's probability for each label, and whether it is rejected."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    numbers = ", ".join(f"`p_{c}` double" for c in chain.labels)
    return texts.mapInArrow(_score(chain), f"doc_id long, {numbers}, rejected boolean")


def without_toxic(docs: DataFrame, chain: Chain, text_column: str = "text") -> DataFrame:
    """The documents that are not rejected, all columns kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in slices(whole_batch, text_column):
                named = pa.RecordBatch.from_arrays([batch.column(text_column)], ["text"])
                p = chain.probabilities(chain.features(named))
                yield batch.filter(pa.array(p[:, -1] < chain.threshold))

    return docs.mapInArrow(run, docs.schema)
