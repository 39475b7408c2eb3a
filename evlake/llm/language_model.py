"""Scores of whole texts under a recurrent language model trained on the corpus.

The corpus is learned from in two ways. Word counts cover every training text and are
a distributed table; the base score, a smoothed unigram, comes from them. The network
(:mod:`evlake.llm.recurrent`) is trained data-parallel: every training text belongs to
one of ``ROUNDS`` rounds; in a round each task trains on its share of the texts from
the common weights, and the tasks' weights are averaged, weighted by their tokens, as
rows of the cluster. The driver holds one set of weights at a time.

A text's log probability carries the network's state from its first word to its end.
The network tells apart the ``MODEL_WORDS`` most frequent words; all others are its
rare class, in which a word w has probability (c(w) + 1) / (tokens + words + 1 of the
class), also for c = 0, so no text is impossible.

Counts of the ``HEAD`` most frequent words (some 4 MB) are sent to every task. Words
beyond them are looked up by a join with the counts, so nothing is left out and
nothing that grows is broadcast. Words are known by 64-bit hashes.

Defined results: a null text counts as empty and consists of its end; a null id counts
as the empty text for the split; rows repeated in full are scored each. An empty table
gives an empty result, and without training texts the counts are all 0.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evlake.llm.arrays import slices, texts_of, words_of
from evlake.llm.common import stored
from evlake.llm.recurrent import Model, Rates, run

FOLDS, HELD_OUT = 7, 2
HEAD = 1 << 18
MODEL_WORDS = 2048
CLASSES = 40
ROUNDS = 3
#: Tokens a task works on side by side.
GROUP_TOKENS = 2_000_000
#: Weights per row when they are averaged.
BLOCK = 4096


def held_out(id_column: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


@dataclass
class _Group:
    """Some rows with the hashes of their texts' words."""

    pieces: list[pa.RecordBatch] = field(default_factory=list)
    hashes: list[np.ndarray] = field(default_factory=list)
    lengths: list[np.ndarray] = field(default_factory=list)
    tokens: int = 0

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(self.hashes), np.concatenate(self.lengths)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[_Group]:
    group = _Group()
    for whole_batch in batches:
        for piece in slices(whole_batch, "text"):
            found = words_of(*texts_of(piece.column("text")))
            group.pieces.append(piece.drop_columns("text") if piece.num_columns > 1 else piece)
            group.hashes.append(found.hashes)
            group.lengths.append(np.diff(found.first))
            group.tokens += len(found.hashes) + piece.num_rows
            if group.tokens >= GROUP_TOKENS:
                yield group
                group = _Group()
    if group.pieces:
        yield group


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in _groups(batches):
        words, n = np.unique(group.words()[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])


@dataclass
class Vocabulary:
    """The most frequent words by hash with their counts, and the corpus totals."""

    words: np.ndarray  # sorted
    counts: np.ndarray
    ids: np.ndarray  # the network's number, or that of the rare class
    rare: int  # the number of the rare class
    documents: int
    tokens: int
    distinct: int

    def model_counts(self) -> np.ndarray:
        """The end's count and those of the network's words, in order of their numbers."""
        own = self.ids < self.rare
        out = np.zeros(self.rare, np.int64)
        out[0] = self.documents
        out[self.ids[own]] = self.counts[own]
        return out

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of every word, and whether it is there."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        return at, self.words[at] == hashes

    def only_model(self) -> "Vocabulary":
        own = self.ids < self.rare
        return Vocabulary(
            self.words[own], self.counts[own], self.ids[own], self.rare, self.documents, self.tokens, self.distinct
        )


def _vocabulary(counts: DataFrame, documents: int) -> Vocabulary:
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).head()
    top = counts.orderBy(F.desc("n"), "word").limit(HEAD).toArrow()
    words, n = top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.lexsort((words, -n))
    words, n = words[order], n[order]
    rare = min(len(words), MODEL_WORDS - 1) + 1
    ids = np.minimum(np.arange(1, len(words) + 1), rare).astype(np.int32)
    by_hash = np.argsort(words)
    ends = 1 if documents else 0
    return Vocabulary(
        words[by_hash], n[by_hash], ids[by_hash], rare, documents, totals[0] + documents, totals[1] + ends
    )


def _tokens(group: _Group, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The network's tokens of a group's texts, ends included, and their offsets."""
    hashes, lengths = group.words()
    at, there = v.find(hashes)
    offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
    tokens = np.zeros(offsets[-1], np.int32)
    word = np.ones(len(tokens), bool)
    word[offsets[1:] - 1] = False
    tokens[word] = np.where(there, v.ids[at], v.rare) if len(v.ids) else v.rare
    return tokens, offsets


def _trainer(flat: np.ndarray, v: Vocabulary):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(v)
        model.unpack(flat)
        rates, seen = Rates(model), 0
        for group in _groups(batches):
            tokens, offsets = _tokens(group, v)
            run(model, tokens, offsets, rates)
            seen += len(tokens)
        if seen:
            own = model.pack().astype(np.float32)
            blocks = [own[i : i + BLOCK].tobytes() for i in range(0, len(own), BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks)), pa.int32()), pa.array(blocks, pa.binary()), pa.array([seen] * len(blocks))],
                ["block", "weights", "seen"],
            )

    return train


def _averaged(rows: pa.Table) -> pa.Table:
    """One block of weights, averaged over the tasks."""
    total, sums = 0, 0.0
    for weights, seen in zip(rows.column("weights"), rows.column("seen"), strict=True):
        sums = sums + np.frombuffer(weights.as_py(), np.float32).astype(np.float64) * seen.as_py()
        total += seen.as_py()
    mean = (sums / total).astype(np.float32).tobytes()
    return pa.table({"block": rows.column("block")[:1], "weights": pa.array([mean], pa.binary())})


def _model(v: Vocabulary) -> Model:
    counts = v.model_counts()
    return Model(counts, v.tokens - counts.sum(), CLASSES)


def train(texts: DataFrame, v: Vocabulary) -> np.ndarray:
    """Weights learned from all rows of ``texts`` (row, text), each used in one round."""
    flat, own = _model(v).pack(), v.only_model()
    for number in range(ROUNDS):
        share = texts.where(F.pmod(F.xxhash64("row_id", "text"), F.lit(ROUNDS)) == number).select("text")
        trained = share.mapInArrow(_trainer(flat, own), "block int, weights binary, seen long")
        mean = trained.groupBy("block").applyInArrow(_averaged, "block int, weights binary")
        blocks = mean.toArrow().sort_by("block").column("weights").to_pylist()
        if blocks:
            flat = np.frombuffer(b"".join(blocks), np.float32)
    return flat


def _scorer(flat: np.ndarray, v: Vocabulary):
    logs = np.log10(v.counts + 1.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(v)
        model.unpack(flat)
        for group in _groups(batches):
            tokens, offsets = _tokens(group, v)
            network = run(model, tokens, offsets) / math.log(10)
            hashes, lengths = group.words()
            at, there = v.find(hashes)
            first = np.concatenate(([0], np.cumsum(lengths)))

            def by_text(x, first=first):
                sums = np.concatenate(([0.0], np.cumsum(x)))
                return sums[first[1:]] - sums[first[:-1]]

            log = np.where(there, logs[at], 0.0) if len(logs) else np.zeros(len(hashes))
            rare = ~there | (v.ids[at] == v.rare) if len(v.ids) else ~there
            missing = hashes[~there]
            cuts = by_text(~there).cumsum().astype(np.int64)
            tails = [missing[a:b].tobytes() for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]
            rows = pa.Table.from_batches(group.pieces).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [
                    *[rows.column(c).combine_chunks() for c in ("row", "doc_id", "held_out")],
                    pa.array(lengths.astype(np.int64) + 1),
                    pa.array(by_text(there).astype(np.int64)),
                    pa.array(by_text(log)),
                    pa.array(by_text(rare).astype(np.int64)),
                    pa.array(by_text(np.where(rare, log, 0.0))),
                    pa.array(network),
                    pa.array(tails, pa.binary()),
                ],
                [*_ROW, "n_tokens", "n_head", "log_head", "n_rare", "log_rare", "network", "tail"],
            )

    return score


_ROW = ["row", "doc_id", "held_out"]
_SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_head long, log_head double,"
    " n_rare long, log_rare double, network double, tail binary"
)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per row and distinct word of its tail."""
    for batch in batches:
        data, offsets = texts_of(batch.column("tail"))
        words = data.view(np.uint64) if len(data) else np.zeros(0, np.uint64)
        row = np.repeat(batch.column("row").to_numpy(), np.diff(offsets) // 8)
        order = np.lexsort((words, row))
        words, row = words[order], row[order]
        fresh = np.append(True, (words[1:] != words[:-1]) | (row[1:] != row[:-1]))[: len(words)]
        at = np.flatnonzero(fresh)
        times = np.diff(np.append(at, len(words)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(row[at], pa.int64()), pa.array(words[at].view(np.int64)), pa.array(times)], ["row", "word", "times"]
        )


def scores(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score, both log10 probabilities of the whole text."""
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("long").alias("doc_id"),
        held_out(id_column).alias("held_out"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(0)).alias("row_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    learned = texts.where("not held_out")
    counts = learned.select("text").mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counts, "word-counts")
    v = _vocabulary(counts, learned.select("held_out").count())
    flat = train(learned.select("row_id", "text"), v)
    # Stored at once, so that row numbers are what they are from here on.
    rows = stored(texts.select(*_ROW, "text").mapInArrow(_scorer(flat, v), _SCORED), "text-scores")
    tails = rows.where(F.octet_length("tail") > 0).select("row", "tail").mapInArrow(_spread, "row long, word long, times long")
    known = tails.join(counts, "word").groupBy("row").agg(
        F.sum("times").alias("n_tail"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("log_tail")
    )
    model = v.model_counts()
    rare_tokens, rare_words = v.tokens - int(model.sum()), v.distinct - int((model > 0).sum())
    every, among_rare = math.log10(v.tokens + v.distinct + 1), math.log10(rare_tokens + rare_words + 1)
    log_tail, end = F.coalesce("log_tail", F.lit(0.0)), math.log10(v.documents + 1)
    known_end = 1 if v.documents else 0
    return rows.drop("tail").join(known, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_tail", F.lit(0)) + known_end).alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("log_head") + log_tail + end - F.col("n_tokens") * every).alias("base_score"),
        (F.col("network") + F.col("log_rare") + log_tail - F.col("n_rare") * among_rare).alias("score"),
    )
