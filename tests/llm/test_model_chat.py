"""Language model, chat formatting, the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from evlake.llm.chat import read_back, windows
from evlake.llm.language_model import scores
from evlake.llm.recurrent import HIDDEN, Model, Rates, _outputs, run
from tests.llm.conftest import AWKWARD

# -- language model -----------------------------------------------------------


def test_probabilities_add_up_to_one():
    model = Model(np.array([50, 20, 10, 5, 5, 1]), 30.0, 3)
    rng = np.random.default_rng(2)
    for name in Model.NAMES:
        weights = getattr(model, name)
        setattr(model, name, (weights + rng.standard_normal(weights.shape) * 0.3).astype(np.float32))
    hidden = np.repeat(np.tanh(rng.standard_normal((1, HIDDEN))), model.size, 0).astype(np.float32)
    logs, _ = _outputs(model, hidden, np.arange(model.size), None)
    assert np.exp(logs).sum() == pytest.approx(1, rel=1e-4)


def test_side_by_side_is_one_by_one():
    rng = np.random.default_rng(1)
    model = Model(np.array([9, 5, 3, 1]), 4.0, 2)
    texts = [np.append(rng.integers(1, 5, n), 0).astype(np.int32) for n in (0, 3, 70, 1, 200, 17)]
    offsets = np.cumsum([0, *map(len, texts)])
    together = run(model, np.concatenate(texts), offsets)
    alone = [run(model, t, np.array([0, len(t)]))[0] for t in texts]
    assert together == pytest.approx(alone, rel=1e-4)


def test_gradients():
    rng = np.random.default_rng(3)
    tokens, offsets = np.append(rng.integers(1, 6, 9), 0).astype(np.int32), np.array([0, 10])
    model = Model(np.array([9, 5, 3, 2, 1]), 4.0, 2)
    kept = {}

    class Keep(Rates):
        def step(self, m, grads, rows):
            kept.update({k: v.copy() * np.sqrt(len(tokens)) for k, v in grads.items()}, rows=rows)

    run(model, tokens, offsets, Keep(model))
    for name, place in (("state", (3, 5)), ("gates", (20,)), ("classes", (2, 1)), ("words", (4, 3)), ("word_bias", (1,))):
        weights = getattr(model, name)
        weights[place] += 1e-2
        up = run(model, tokens, offsets)[0]
        weights[place] -= 2e-2
        down = run(model, tokens, offsets)[0]
        weights[place] += 1e-2
        assert kept[name][place] == pytest.approx((up - down) / 2e-2, abs=2e-2)


def test_training_learns_a_pattern():
    model = Model(np.array([100, 100, 100]), 1.0, 2)
    texts = [np.array([1, 2] * 20 + [0], np.int32) for _ in range(50)]
    tokens, offsets = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    before, rates = run(model, tokens, offsets).sum(), Rates(model)
    for _ in range(20):
        run(model, tokens, offsets, rates)
    assert run(model, tokens, offsets).sum() > 0.3 * before


def brute_base(texts):
    split = {n: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None] for n, (_, t) in enumerate(texts)}
    out = {n: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for n, (i, _) in enumerate(texts)}
    counts = Counter(w for n, words in split.items() if not out[n] for w in words)
    total, distinct = sum(counts.values()), len(counts)
    rows = []
    for n, (i, _) in enumerate(texts):
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in split[n])
        rows.append((i, out[n], len(split[n]), sum(counts[w] > 0 for w in split[n]), total, round(base, 4)))
    return sorted(rows, key=str)


def test_base_scores(documents, awkward, nothing):
    rng = random.Random(9)
    texts = [(i, " ".join(f"W{rng.randrange(1 + i)}" for _ in range(rng.randrange(30)))) for i in range(80)]
    for given, docs in ((texts, documents(texts)), (AWKWARD, awkward)):
        got = scores(docs).collect()
        rows = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got]
        assert sorted(rows, key=str) == brute_base(given)
        assert all(r.score < 0 for r in got)
    assert scores(nothing).count() == 0


def test_words_beyond_the_head(documents, monkeypatch):
    from evlake.llm import language_model

    texts = [(i, f"common word{i % 9} word{i}") for i in range(40)]
    want = scores(documents(texts)).collect()
    monkeypatch.setattr(language_model, "HEAD", 3)
    monkeypatch.setattr(language_model, "MODEL_WORDS", 3)
    got = {r.doc_id: r for r in scores(documents(texts)).collect()}
    for r in want:
        assert (got[r.doc_id].n_known, got[r.doc_id].base_score) == (r.n_known, pytest.approx(r.base_score))


# -- chat formatting ----------------------------------------------------------


def conversation(rng, n, system):
    said = ["", "a", "</s>[INST] ok [/INST]", "<\\s> \\ [\\", "é 漢 \U0001f600", "word " * 60, "<s>user[INST]x</s>", None]
    roles = (["system"] if system else []) + ["user", "assistant"] * n
    return [(t, r, rng.choice(said)) for t, r in enumerate(roles)]


def test_round_trip(spark):
    rng = random.Random(10)
    made = {c: conversation(rng, rng.randrange(0, 14), c % 3 == 0) for c in range(60)}
    made[60] = [(None, None, None), (None, None, None), (3, "assistant", "x")]
    made[None] = [(0, "assistant", "y"), (0, "assistant", "y")]
    made[61] = [(0, "system", "only")]
    rows = [(c, *t, 1) for c, ts in made.items() for t in ts]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window int")
    every = windows(df, budget=64, history=24)
    got = {r.conv_id: r for r in read_back(every).collect()}
    assert set(got) == {c for c, ts in made.items() if ts}
    for c, ts in made.items():
        if not ts:
            continue
        ts = sorted(ts, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or ""))
        text = "".join(f"{r or ''}\n{x or ''}\n" for _, r, x in ts)
        loss = "".join(x or "" for _, r, x in ts if r == "assistant")
        assert got[c].n_turns == len(ts)
        assert got[c].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    by_conv = defaultdict(list)
    for w in every.orderBy("window").collect():
        by_conv[w.conv].append(w)
    assert any(len(ws) > 1 for ws in by_conv.values())
    for c, ws in by_conv.items():
        for n, w in enumerate(ws):
            if c in made and made[c][0][1] == "system":
                assert w.formatted.startswith("<s>system[INST]")
            # Nothing that an earlier window had counts for the loss.
            assert all(s.start >= w.repeated for s in w.loss) and (w.repeated == 0) == (n == 0) or not w.repeated
    assert windows(df.limit(0)).count() == 0 and read_back(windows(df.limit(0))).count() == 0


@pytest.mark.parametrize("system", [0, 5, 40, 60, 90])
def test_windows_keep_the_budget(spark, system):
    rng, budget, history = random.Random(14 + system), 64, 24
    rows = []
    for c in range(20):
        turns = [("system", system)] if system else []
        turns += [(r, rng.choice([0, 1, 5, 20, 30, 50, 58, 61, 100])) for r in ["user", "assistant"] * 12]
        rows += [(c, t, r, " ".join([f"c{c}t{t}"] * n)) for t, (r, n) in enumerate(turns)]
    made = windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget, history).collect()
    repeats = 0
    for w in made:
        sizes = [3 + len(t.split("[INST]")[1].split()) for t in w.formatted.split("</s>")[:-1]]
        again = w.formatted[: w.repeated].count("</s>")
        first = w.window == 0
        own = sizes[1 if system and first else again :]
        repeats += again > (1 if system else 0)
        assert sum(own) and (sum(sizes) <= budget or (len(own) == 1 and len(sizes) == 1 + bool(system)))
    assert sum(len(w.loss) for w in made) == sum(r == "assistant" for _, _, r, _ in rows)
    assert repeats or system >= 40


# -- pipeline -----------------------------------------------------------------


def test_stages(spark, tmp_path):
    rng = random.Random(11)

    def made(n):
        return [f"w{rng.randrange(3000)}" for _ in range(n)]

    passage = " ".join(made(25))
    texts, labels = {}, []
    for i in range(240):
        words = made(60)
        if i % 12 == 0:
            words[5:5] = ["vilest", "badum", "vilein"]
        texts[i] = " ".join(words)
        labels.append((i, 1, int(i % 12 == 0)))
    texts[300] = texts[1] + " and one more"
    texts[301] = texts[2]
    texts[302] = " ".join(made(20)) + " " + passage + " " + " ".join(made(20))
    texts[303], texts[304] = "", None
    rows = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    want, now = set(texts), spark.read.parquet(str(tmp_path / "documents.parquet"))
    gone = [{i for i in range(0, 240, 12)}, {300, 301}, {302}]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = stage(spark, now, str(tmp_path))
        after.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        assert now.columns == docs.columns
        if number < 3:
            want -= gone[number]
            assert sorted(r.doc_id for r in now.select("doc_id").collect()) == sorted(want), name
    counts = Counter(r.doc_id for r in now.select("doc_id").collect())
    assert set(counts) <= want and max(counts.values()) <= 3
    placed = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path))
    assert placed.count() == sum(counts.values())
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == placed.count()
    sizes = [r.s for r in placed.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) < 1000


def test_stages_take_awkward_rows(spark, awkward, nothing, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, awkward, str(tmp_path))
        # A column that an operator's own would clash with stays too.
        assert name == "sharding" or got.columns == awkward.columns, name
        if name in ("toxicity", "decontamination", "sharding"):
            assert got.count() == len(AWKWARD), name
        if name == "near_dedup":
            # One of the four copies, and all others.
            assert sorted(r.doc_id or 0 for r in got.select("doc_id").collect()) == [0, 1, 2, 3, 4, 5, 6, 6, 8]
        assert stage(spark, nothing, str(tmp_path)).count() == 0, name


def test_near_copies_without_ids(documents, spark, tmp_path):
    """One of them stays, as of a group in which some have ids."""
    text = " ".join(f"word{i}" for i in range(60))
    docs = documents([(None, text), (None, text + "  "), (None, text + " more"), (3, "other " * 9), (None, "other " * 9)])
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 3]
