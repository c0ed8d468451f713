"""Language-model scores against plain sums over words."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import lbl

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def words(text):
    return [w for w in (text or "").translate(UPPER).encode().split()] + [b"<end>"]


def is_held(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 == 2


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def expected(rows):
    counts = Counter(w for i, t in rows if not is_held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        found = words(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in found)
        out.append((i, is_held(i), len(found), sum(counts[w] > 0 for w in found), n, base))
    return out


def sentences(n, seed=5):
    """Texts in which every word says much about the next."""
    rng = np.random.default_rng(seed)
    nouns = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        at, said = int(rng.integers(60)), []
        for _ in range(int(rng.integers(5, 60))):
            said.append(nouns[at] if rng.random() > 0.05 else f"x{rng.integers(3000)}")
            at = (7 * at + int(rng.integers(3))) % 60
        out.append((i, " ".join(said).capitalize()))
    return out


EDGES = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "One one ONE two"), (None, "null id"), (7, "again"), (7, "again"),
    (8, "long " * 50_000 + "z" * 5_000), (9, "y" * 33 + " " + "y" * 32 + " " + "y" * 33), (10, "É é ÀB"), (11, "\x1c \x85 word"),
    *[(i, f"held or not {i}") for i in range(20, 60)],
]


def compare(spark, rows):
    got = lbl.report(frame(spark, rows).withColumns({c: F.lit("x") for c in ("row", "word", "c", "ids", "n_tokens")}))
    assert got.columns == COLUMNS
    got = sorted(map(tuple, got.collect()), key=repr)
    want = sorted(expected(rows), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    np.testing.assert_allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert all(math.isfinite(g[6]) and g[6] <= 0 for g in got)
    return got


@pytest.mark.parametrize("tier,own", [(1 << 19, 4_096), (6, 3), (6, 6), (70, 64)])
def test_base_scores_whatever_the_tier(spark, monkeypatch, tier, own):
    monkeypatch.setattr(lbl, "TIER", tier)
    monkeypatch.setattr(lbl, "WORDS", own)
    compare(spark, EDGES)


def test_empty_tables_and_no_training_rows(spark):
    assert lbl.report(frame(spark, [])).collect() == []
    held = [i for i in range(100) if is_held(i)][:3]
    rows = lbl.report(frame(spark, [(i, "some words") for i in held])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows] == [(3, 0, 0, 0.0, 0.0)] * 3


def test_probabilities_of_all_words_add_up_to_one(spark, monkeypatch):
    monkeypatch.setattr(lbl, "WORDS", 130)
    rows = frame(spark, sentences(300)).withColumn("held_out", lbl.held_out(F.col("doc_id")))
    counts = lbl.word_counts(rows.where("NOT held_out").select("text")).persist()
    known = lbl.vocabulary(counts)
    model = lbl.trained(lbl.encoded(rows, known).persist(), known)
    random = np.random.default_rng(2)
    for _ in range(5):
        before = np.tile(random.integers(0, known.size + 2, lbl.CONTEXT), (known.size + 1, 1))
        each = np.exp(model.log_probabilities(before, np.arange(known.size + 1)))
        other = 10 ** known.rest_log(known.counts[known.size :])
        unknown = 10 ** known.rest_log(np.zeros(1))
        assert each.sum() == pytest.approx(1, abs=1e-5)
        assert other.sum() + unknown.sum() == pytest.approx(1, abs=1e-9)


def test_scores_are_sums_over_words(spark, monkeypatch):
    """Scores of the query against one word at a time, with words in and out of tier and model."""
    monkeypatch.setattr(lbl, "TIER", 90)
    monkeypatch.setattr(lbl, "WORDS", 70)
    made = []
    trained = lbl.trained
    monkeypatch.setattr(lbl, "trained", lambda *a: made.append((trained(*a), a[1])) or made[0][0])
    rows = sentences(120)
    got = {r.doc_id: r.score for r in lbl.report(frame(spark, rows)).collect()}
    model, known = made[0]
    counts = Counter(w for i, t in rows if not is_held(i) for w in words(t))
    rank = {w or b"<end>": k for k, w in enumerate(known.words[: known.size])}
    n, v = known.rest
    for i, text in rows[:30]:
        past, total = [known.size + 1] * lbl.CONTEXT, 0.0
        for word in words(text):
            k = rank.get(word, known.size)
            total += model.log_probabilities(np.array([past[::-1][: lbl.CONTEXT]]), np.array([k]))[0] / math.log(10)
            total += math.log10((counts[word] + 1) / (n + v + 1)) if k == known.size else 0
            past.append(k)
        assert got[i] == pytest.approx(total, rel=1e-5)


def test_learns_from_context_and_repeats(spark):
    rows = sentences(3_000)
    first = compare(spark, rows)
    held = [r for r in first if r[1]]
    assert len(held) > 200
    per_word = [sum(r[k] for r in held) / sum(r[2] for r in held) for k in (5, 6)]
    assert per_word[1] > per_word[0] + 0.3  # log10 units a word
    again = sorted(map(tuple, lbl.report(frame(spark, rows)).collect()), key=repr)
    np.testing.assert_allclose([r[6] for r in again], [r[6] for r in first], rtol=1e-3)
