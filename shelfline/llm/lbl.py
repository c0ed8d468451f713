"""Language-model scores: a log-bilinear neural model trained by noise-contrastive estimation.

1. *Counts* of every word over all training documents: counters of the tasks, summed by word.
2. *Encoding.* The ``TIER`` most frequent words go to all tasks; of them the first ``WORDS``
   are the model's own words. A document keeps the numbers of its words and, for words outside
   the tier, the words themselves. Only those are joined with the table of all counts, so the
   shuffle carries the tail of the vocabulary and no frequent word.
3. *Model.* The vectors of the ``CONTEXT`` words before, each weighted by its position, add up
   to a prediction whose products with the vectors of classes and words give log scores. A word
   belongs to one of ``CLASSES`` classes: the probability of the class, times that of the word
   in its class, both normalised exactly by matrix products over all classes and all words of
   a class. One further class holds all other words; in it a word has its add-one share of the
   counts, an unknown word that of a count of 0. So the probabilities of all words add up to 1.
4. *Training* is noise-contrastive at both levels: a binary choice between the word (class) seen
   and words (classes) drawn from their frequencies. Every training word of the corpus is
   used once: each round takes a share of the documents, every task learns from its own rows
   in numpy, and the weighted mean of the tasks' parameters, added up by blocks, starts the
   next round. It begins at the frequencies, that is at a unigram model.

Words are runs of non-white ASCII space after lower-casing A-Z; a text is its words and one
end. A word of more than ``LONG`` bytes is known by a digest.

Defined cases: null texts are empty, and an empty text is one end; a null id counts as the
empty text, so such rows are training rows; repeated rows and ids count as often as they
occur; without training documents every probability is 1 and scores are 0; an empty table has
no scores; texts of any length are read whole, in pieces of ``PIECE`` words; ties in frequency
go to the smaller word; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import kept_in_worker, saved, text_bytes

#: Words in the broadcast tier (of at most ``LONG`` bytes each) and in the model.
TIER, WORDS, LONG = 1 << 19, 4_096, 32
CLASSES, DIM, CONTEXT = 64, 32, 3
#: Passes that share the training documents, words of a step, draws of noise a step.
ROUNDS, STEP, NOISE = 4, 8_192, 24
RATE = 0.3
#: Words handled at once, distinct words counted at once, parts of the summed parameters.
PIECE, COUNTED, BLOCKS = 1 << 17, 400_000, 16
#: Words scored by one matrix product.
SCORED = 1 << 14
END = b""
NEVER = -1e9

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """The words of a text and its end."""
    out = text.translate(LOWER).split()
    out.append(END)
    return out


def known_by(word: bytes) -> bytes:
    """A word, or of a long one a digest; no text holds the byte it begins with."""
    return word if len(word) <= LONG else b"\xff" + hashlib.blake2b(word, digest_size=LONG - 1).digest()


def held_out(key: Column, parts: int = 7, part: int = 2) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == part


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` and its number ``c`` over all of ``texts`` (one column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def told() -> pa.RecordBatch:
            held: Counter[bytes] = Counter()
            for word, n in seen.items():
                held[known_by(word)] += n
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "c"])

        for batch in batches:
            for text in text_bytes(batch.column(0)):
                seen.update(words_of(text))
                if len(seen) > COUNTED:
                    yield told()
        yield told()

    return texts.mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """Totals of all words, and the most frequent words with their counts."""

    total: int
    distinct: int
    words: list[bytes]
    counts: np.ndarray

    @property
    def size(self) -> int:
        """Words of the model."""
        return min(WORDS, len(self.words))

    @property
    def rest(self) -> tuple[int, int]:
        """Sum of counts and number of the words that are not in the model."""
        return self.total - int(self.counts[: self.size].sum()), self.distinct - self.size

    def base_log(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.total + self.distinct + 1))

    def rest_log(self, count: np.ndarray) -> np.ndarray:
        total, distinct = self.rest
        return np.log10((count + 1) / (total + distinct + 1))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals, and all words from the least count on of which at most ``TIER`` words have so many.

    Counts are told apart by eighths of their logarithm to base 2, so that the search for that
    count sees a few hundred rows, and no task sorts the vocabulary.
    """
    size = F.floor(F.log2("c") * 8 + 1e-9)
    steps = counts.groupBy(size.alias("size")).agg(F.sum("c").alias("c"), F.count("*").alias("words")).collect()
    held, least = 0, math.inf
    for step in sorted(steps, key=lambda r: -r["size"]):
        held += step["words"]
        if held > TIER:
            break
        least = step["size"]
    top = [(r["word"], r["c"]) for r in counts.where(size >= least).toArrow().to_pylist()] if steps else []
    top.sort(key=lambda r: (-r[1], r[0]))
    return Vocabulary(sum(r["c"] for r in steps), sum(r["words"] for r in steps), [w for w, _ in top], np.array([c for _, c in top], np.int64))


ENCODED = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("known", T.LongType()),
        T.StructField("base", T.DoubleType()),
        T.StructField("rest", T.DoubleType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("rare", T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("m", T.LongType())]))),
    ]
)


def encoded(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """Numbers of each document's words, what the tier says of them, and the words outside it.

    ``ids``: 16-bit numbers by rank; ``known.size`` stands for words that are not in the model.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    schema = T.StructType([rows.schema["row"], rows.schema["doc_id"], rows.schema["held_out"], *ENCODED.fields[3:]])
    sent = docs.sparkSession.sparkContext.broadcast((known.words, known.counts))
    size, name = known.size, hashlib.blake2b(b"\n".join(known.words)).hexdigest()
    total, distinct, rest = known.total, known.distinct, known.rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class Ranks(dict):
            def __missing__(self, word: bytes) -> int:
                return len(self)

        words, counts = sent.value
        rank = kept_in_worker("lbl_ranks", name, lambda: Ranks(zip(words, range(len(words)), strict=True)))
        outside = len(words)
        base = np.append(np.log10((counts + 1) / (total + distinct + 1)), 0.0)
        other = np.append(np.log10((counts + 1) / (rest[0] + rest[1] + 1)), 0.0)
        other[:size] = 0.0

        def described(text: bytes) -> tuple:
            found = words_of(text)
            n, known_here, base_sum, rest_sum = len(found), 0, 0.0, 0.0
            ids, rare = [], Counter()
            for start in range(0, n, PIECE):
                part = found[start : start + PIECE]
                r = np.fromiter(map(rank.__getitem__, part), np.int64, len(part))
                away = np.flatnonzero(r == outside)
                known_here += len(part) - len(away)
                base_sum += float(base[r].sum())
                rest_sum += float(other[r].sum())
                rare.update(known_by(part[i]) for i in away.tolist())
                ids.append(np.minimum(r, size).astype(np.uint16).tobytes())
            # Long words of the tier are looked up by their digest here.
            for word in [w for w in rare if len(w) == LONG and w[0] == 255 and w in rank]:
                m, r = rare.pop(word), rank[word]
                known_here, base_sum, rest_sum = known_here + m, base_sum + m * base[r], rest_sum + m * other[r]
            return n, known_here, base_sum, rest_sum, b"".join(ids), list(rare.items())

        for batch in batches:
            rows = [described(t) for t in text_bytes(batch.column(3))]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()))]
            flat = [item for r in rows for item in r[5]]
            pair = pa.StructArray.from_arrays(
                [pa.array([w for w, _ in flat], pa.binary()), pa.array([m for _, m in flat], pa.int64())], names=["word", "m"]
            )
            ends = np.cumsum([0, *[len(r[5]) for r in rows]])
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pair))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


@dataclass
class Model:
    """Parameters and the sums of squares that scale their steps (one a row, or an entry of a bias).

    Words stand class by class: word of rank ``r`` at class ``r % CLASSES``, slot ``r // CLASSES``.
    """

    size: int
    p_class: np.ndarray
    p_word: np.ndarray
    context: np.ndarray
    position: np.ndarray
    classes: np.ndarray
    class_bias: np.ndarray
    words: np.ndarray
    word_bias: np.ndarray
    #: Of contexts, positions, classes, class biases, words, word biases.
    seen: list[np.ndarray]

    @classmethod
    def of(cls, known: Vocabulary) -> Model:
        size, slots = known.size, max(1, -(-known.size // CLASSES))
        held = np.zeros(slots * CLASSES)
        held[:size] = known.counts[:size]
        held = held.reshape(slots, CLASSES).T
        mass = np.append(held.sum(axis=1), known.rest[0] + 1.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            # Padding and classes without words have no share.
            p_class, p_word = mass / mass.sum(), np.where(held > 0, held / held.sum(axis=1, keepdims=True), 0.0)
            log = lambda p: np.where(p > 0, np.log(p), NEVER).astype(np.float32)
            bias, word_bias = log(p_class), log(p_word)
        random = np.random.default_rng(11)
        small = lambda *shape: np.zeros(shape, np.float32)
        context = (0.3 * random.standard_normal((size + 2, DIM))).astype(np.float32)
        seen = [small(size + 2), small(CONTEXT), small(CLASSES + 1), small(CLASSES + 1), small(CLASSES, slots), small(CLASSES, slots)]
        position = np.full((CONTEXT, DIM), 1.0, np.float32) / np.arange(1, CONTEXT + 1, dtype=np.float32)[:, None]
        return cls(size, p_class, p_word, context, position, small(CLASSES + 1, DIM), bias, small(CLASSES, slots, DIM), word_bias, seen)

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.position, self.classes, self.class_bias, self.words, self.word_bias, *self.seen]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def with_flat(self, flat: np.ndarray) -> Model:
        out, at = [], 0
        for a in self.arrays():
            out.append(flat[at : at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return Model(self.size, self.p_class, self.p_word, *out[:6], out[6:])

    def prediction(self, before: np.ndarray) -> np.ndarray:
        """Predicted vectors from the numbers of the words before (one row each, nearest first)."""
        out = self.context.take(before[:, 0], axis=0)
        out *= self.position[0]
        for i in range(1, CONTEXT):
            part = self.context.take(before[:, i], axis=0)
            part *= self.position[i]
            out += part
        return out

    def _by_class(self, ids: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """An order of the words class by class, and the stretch of each class (other words last)."""
        group = np.where(ids < self.size, ids % CLASSES, CLASSES).astype(np.uint8)
        order = np.argsort(group, kind="stable")
        cuts = np.cumsum([0, *np.bincount(group, minlength=CLASSES + 1)]).tolist()
        return order, list(zip(cuts, cuts[1:], strict=False))

    def log_probabilities(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural logs of the normalised probabilities; of ``size`` that of the class of other words."""
        out = np.empty(len(ids))
        for start in range(0, len(ids), SCORED):
            part = slice(start, start + SCORED)
            order, stretches = self._by_class(ids[part])
            predicted, slot = self.prediction(before[part][order]), ids[part][order] // CLASSES
            scores = predicted @ self.classes.T + self.class_bias
            logs = -_log_sum(scores)
            for k, (a, b) in enumerate(stretches):
                if a == b:
                    continue
                logs[a:b] += scores[a:b, k]
                if k < CLASSES:
                    each = predicted[a:b] @ self.words[k].T + self.word_bias[k]
                    logs[a:b] += each[np.arange(b - a), slot[a:b]] - _log_sum(each)
            out[start + order] = logs
        return out

    def _moved(self, which: int, array: np.ndarray, gradient: np.ndarray) -> None:
        """A step along ``gradient``, shorter the more its rows have moved before."""
        seen = self.seen[which]
        wide = gradient.ndim > seen.ndim
        seen += np.einsum("...i,...i->...", gradient, gradient) / gradient.shape[-1] if wide else gradient * gradient
        scale = RATE / np.sqrt(seen + 1e-6)
        array += gradient * (scale[..., None] if wide else scale)

    def learn(self, before: np.ndarray, ids: np.ndarray, random: np.random.Generator) -> None:
        """One noise-contrastive step on words ``ids`` after ``before``."""
        order, stretches = self._by_class(ids)
        before, slot = before[order], ids[order] // CLASSES
        predicted = self.prediction(before)
        with np.errstate(divide="ignore", over="ignore"):
            class_less = np.log(NOISE * self.p_class)
            word_less = np.log(NOISE * self.p_word).astype(np.float32)
            # Classes drawn: every row against each of them, as often as it was drawn.
            times = random.multinomial(NOISE, self.p_class)
            drawn = np.flatnonzero(times)
            apart = self.class_bias[drawn] - class_less[drawn].astype(np.float32)
            push = _chance(predicted @ self.classes[drawn].T + apart) * -times[drawn].astype(np.float32)
            back = push @ self.classes[drawn]
            turn, lift = np.zeros_like(self.classes), np.zeros_like(self.class_bias)
            turn[drawn], lift[drawn] = push.T @ predicted, push.sum(axis=0)
            word_turn, word_lift = np.zeros_like(self.words), np.zeros_like(self.word_bias)
            held = self.p_word.sum(axis=1) > 0
            times = np.zeros(self.p_word.shape, np.float32)
            if held.any():
                times[held] = random.multinomial(NOISE, self.p_word[held])
            for k, (a, b) in enumerate(stretches):
                if a == b:
                    continue
                own = predicted[a:b]
                pull = 1 - _chance(own @ self.classes[k] + (self.class_bias[k] - np.float32(class_less[k])))
                back[a:b] += pull[:, None] * self.classes[k]
                turn[k] += pull @ own
                lift[k] += pull.sum()
                if k == CLASSES:
                    continue
                chance = _chance(own @ self.words[k].T + np.maximum(self.word_bias[k] - word_less[k], NEVER / 2))
                push = chance * -times[k]
                rows, at = np.arange(b - a), slot[a:b]
                push[rows, at] += 1 - chance[rows, at]
                word_turn[k], word_lift[k] = push.T @ own, push.sum(axis=0)
                back[a:b] += push @ self.words[k]
        self._moved(2, self.classes, turn)
        self._moved(3, self.class_bias, lift)
        self._moved(4, self.words, word_turn)
        self._moved(5, self.word_bias, word_lift)
        turn, sway = np.zeros_like(self.context), np.empty_like(self.position)
        for i in range(CONTEXT):
            at = before[:, i].astype(np.uint16)
            order = np.argsort(at, kind="stable")
            at = at[order]
            starts = np.flatnonzero(np.diff(at.astype(np.int32), prepend=-1))
            sums, at = np.add.reduceat(back[order], starts, axis=0), at[starts]
            sway[i] = np.einsum("ij,ij->j", sums, self.context[at]) * (0.1 / len(ids))
            turn[at] += sums * self.position[i]
        self._moved(0, self.context, turn)
        self._moved(1, self.position, sway)


def _log_sum(scores: np.ndarray) -> np.ndarray:
    """Logs of the row sums of exponentials; one shift for all rows while that underflows in none."""
    top = scores.max()
    sums = np.exp(scores - top) @ np.ones(scores.shape[1], np.float32)
    if sums.min() < 1e-30:
        top = scores.max(axis=1)
        sums = np.exp(scores - top[:, None]).sum(axis=1)
    return (top + np.log(sums)).astype(float)


def _chance(scores: np.ndarray) -> np.ndarray:
    """The logistic function, in place."""
    np.negative(scores, out=scores)
    np.exp(scores, out=scores)
    scores += 1
    return np.reciprocal(scores, out=scores)


def stream(ids: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts in one row: those before each, the words, and the place of each text's first."""
    start = np.full(CONTEXT, size + 1, np.int64)
    texts = [np.frombuffer(raw, np.uint16).astype(np.int64) for raw in ids]
    whole = np.concatenate([part for text in texts for part in (start, text)]) if texts else np.zeros(0, np.int64)
    at = np.flatnonzero(whole != size + 1)
    before = np.stack([whole[at - i] for i in range(1, CONTEXT + 1)], axis=1) if len(at) else np.zeros((0, CONTEXT), np.int64)
    return before, whole[at], np.cumsum([0, *[len(t) for t in texts]])


def _trained_once(rows: DataFrame, model: Model) -> Model:
    """The mean of what every task makes of ``model`` by its own ``ids``, weighted by their words."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        own = sent.value.with_flat(sent.value.flat())
        random, seen = np.random.default_rng(part), 0
        for batch in batches:
            for group in pieces(batch.column(0).to_pylist()):
                before, ids, _ = stream(group, own.size)
                order = random.permutation(len(ids))
                for start in range(0, len(ids), STEP):
                    some = order[start : start + STEP]
                    own.learn(before[some], ids[some], random)
                seen += len(ids)
        if seen:
            for at, block in enumerate(np.array_split(own.flat(), BLOCKS)):
                columns = [pa.array([at]), pa.array([part]), pa.array([seen]), pa.array([block.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["at", "part", "seen", "block"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for at, _, seen, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n, total = sums.get(at, (0, 0.0))
                sums[at] = n + seen, total + seen * np.frombuffer(block, np.float32).astype(float)
        found = [(at, (total / n).astype(np.float32).tobytes()) for at, (n, total) in sums.items()]
        columns = [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["at", "block"])

    parts = rows.mapInArrow(learn, "at bigint, part bigint, seen bigint, block binary")
    means = parts.repartition(BLOCKS, "at").sortWithinPartitions("at", "part").mapInArrow(add, "at bigint, block binary")
    found = {r["at"]: np.frombuffer(r["block"], np.float32) for r in means.collect()}
    return model.with_flat(np.concatenate([found[i] for i in range(BLOCKS)])) if found else model


def pieces(ids: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in groups of about ``PIECE`` words; a longer text alone."""
    group, held = [], 0
    for raw in ids:
        if group and held + len(raw) // 2 > PIECE:
            yield group
            group, held = [], 0
        group.append(raw)
        held += len(raw) // 2
    if group:
        yield group


def trained(rows: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> Model:
    """A model of the documents that are not held out; every one is used in one of the rounds."""
    model = Model.of(known)
    learned = rows.where(~F.col("held_out"))
    for k in range(rounds if known.size else 0):
        model = _trained_once(learned.where(F.pmod(F.xxhash64("row"), F.lit(rounds)) == k).select("ids"), model)
    return model


def with_model_log(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` without ``ids`` and ``rare``, with ``model_log``: the log10 probability that the classes give."""
    kept = rows.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "rest", "ids")
    schema = T.StructType([*kept.schema.fields[:-1], T.StructField("model_log", T.DoubleType())])
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            out: list[float] = []
            for group in pieces(batch.column(7).to_pylist()):
                before, ids, firsts = stream(group, own.size)
                logs = np.zeros(len(ids))
                for start in range(0, len(ids), PIECE):
                    part = slice(start, start + PIECE)
                    logs[part] = own.log_probabilities(before[part], ids[part])
                out += (np.add.reduceat(logs, firsts[:-1]) / math.log(10)).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(out, pa.float64())], names=schema.names)

    return kept.mapInArrow(run, schema)


def _of_rare(rows: DataFrame, counts: DataFrame, known: Vocabulary) -> DataFrame:
    """By ``row``, what the words outside the tier add."""
    words = rows.select("row", F.explode("rare").alias("x")).select("row", "x.word", "x.m")
    joined = words.join(counts, "word", "left")
    n, v = known.rest
    count, m = F.coalesce("c", F.lit(0)) + 1, F.col("m")
    return joined.groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), m).otherwise(0)).alias("rare_known"),
        F.sum(m * F.log10(count / F.lit(float(known.total + known.distinct + 1)))).alias("rare_base"),
        F.sum(m * F.log10(count / F.lit(float(n + v + 1)))).alias("rare_rest"),
    )


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Unigram and model scores (log10) of every document."""
    marked = docs.select(F.col(f"`{key}`").alias("doc_id"), held_out(F.col(f"`{key}`")).alias("held_out"), F.col(f"`{text}`").cast("string").alias("text"))
    counts = saved(word_counts(marked.where(~F.col("held_out")).select("text")), "lbl_counts")
    known = vocabulary(counts)
    rows = saved(encoded(marked, known), "lbl_encoded")
    model = trained(rows, known)
    scored = with_model_log(rows, model).join(_of_rare(rows, counts, known), "row", "left")
    added = lambda column, other: F.col(column) + F.coalesce(F.col(other), F.lit(0))
    return scored.select(
        F.col("doc_id").alias(key),
        "held_out",
        "n_tokens",
        added("known", "rare_known").alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        added("base", "rare_base").alias("base_score"),
        (F.col("model_log") + added("rest", "rare_rest")).alias("score"),
    )
