"""Toxicity: distance-weighted votes of the nearest labelled examples.

Examples are a bounded sample of labelled rows outside the held-out third (``EXAMPLES``
rows of smallest hash). Terms are words and their beginnings of a few lengths (compounds
share a beginning, not the word), and both again when a text repeats them; the vocabulary is the ``TERMS`` terms of the examples that
tell the classes apart best (chi-square of at least ``CHI`` an
example, in at least ``DF`` examples). Everything
else covers whole texts of all documents. Similarity is the exact cosine of TF-IDF vectors.

The examples are an inverted index in blocks of ``BLOCK``: for each term and block the
postings and their largest weight. A document's bounds for all blocks are one sum over its
terms; blocks are visited by falling bound and the rest is skipped once no bound reaches
the k-th similarity found. The vote of the neighbours, smoothed by the base rate, is mapped
to a probability by isotonic regression on the examples' own leave-one-out votes.

The index is broadcast; its size is bounded by the two parameters. Documents are never
shuffled. Evidence is the neighbours with their similarities.

Defined cases: null and empty texts, and texts without a known word, have no neighbours and
get the base rate's score; ties go to the smaller example id; documents that repeat an
example's id count once, by their smallest text; conflicting labels count as toxic; without
examples every score is 0.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import release_kept, saved, text_bytes, with_scanned
from shelfline.llm.decontaminate import words_of

EXAMPLES = 8_000
TERMS = 512
#: Least chi-square, as a share of the number of examples, and least number of examples.
CHI, DF = 0.006, 4
BLOCK = 64
#: Blocks that a search visits one by one before it adds up what may still count at once.
FEW = 3
NEIGHBOURS = 15
#: Lengths, in characters, of the beginnings of longer words that are terms as well.
BEGINNINGS = (4, 5, 6, 7)
#: A term that a text holds so often or more counts as a term of its own, too.
REPEATS = (2, 4)
#: Words whose terms a worker remembers.
CACHE = 300_000
#: Weight of the base rate among the votes.
SMOOTHING = 0.3
REJECT = 0.7

FIELDS = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "evidence",
            T.ArrayType(
                T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("toxic", T.IntegerType())])
            ),
        ),
    ]
)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def terms_of(word: bytes) -> list[bytes]:
    """The word and its beginnings, marked by a star, which no word holds."""
    text = word.decode("utf-8", "replace")
    return [word, *(text[:k].encode() + b"*" for k in BEGINNINGS if len(text) > k)]


def with_repeats(found: Counter) -> dict[bytes, int]:
    repeated = {term + b"#%d" % m: n for term, n in found.items() for m in REPEATS if n >= m}
    return found | repeated


class KnownTerms(dict):
    """Word -> numbers of its terms in use; remembers up to ``CACHE`` words."""

    def __init__(self, terms: dict[bytes, int]):
        self.bases: dict[bytes, int] = {}
        self.levels: list[list[tuple[int, int]]] = []
        for term, t in terms.items():
            base, _, least = term.partition(b"#")
            if base not in self.bases:
                self.bases[base] = len(self.levels)
                self.levels.append([])
            self.levels[self.bases[base]].append((int(least or 1), t))

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        found = tuple(self.bases[t] for t in terms_of(word) if t in self.bases)
        if len(self) >= CACHE:
            self.clear()
        self[word] = found
        return found

    def counts(self, words: list[bytes]) -> dict[int, int]:
        """How often each term of the vocabulary stands in a text."""
        tally: dict[int, int] = {}
        for word, n in Counter(words).items():
            for base in self[word]:
                tally[base] = tally.get(base, 0) + n
        return {t: n for base, n in tally.items() for least, t in self.levels[base] if n >= least}


@dataclass
class BlockMaxIndex:
    """Examples as blocks of postings with the largest weight of each term in each block."""

    terms: dict[bytes, int]
    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    postings: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    cuts: np.ndarray | None = None
    most: np.ndarray | None = None
    base: float = 0.0
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def build(self, counts: list[dict[int, int]]) -> BlockMaxIndex:
        blocks = -(-len(counts) // BLOCK)
        lists: list[list[tuple[int, float]]] = [[] for _ in self.idf]
        for row, found in enumerate(counts):
            for t, w in zip(*self.weights(found), strict=True):
                lists[t].append((row, w))
        self.cuts = np.zeros((len(lists), blocks + 1), np.int64)
        self.most = np.zeros((len(lists), blocks))
        for t, rows in enumerate(lists):
            at = np.array([r for r, _ in rows], np.int64)
            w = np.array([x for _, x in rows])
            self.postings.append((at, w))
            self.cuts[t] = np.searchsorted(at, np.arange(blocks + 1) * BLOCK)
            if len(at):
                np.maximum.at(self.most[t], at // BLOCK, w)
        self.base = float(self.toxic.mean()) if len(self.toxic) else 0.0
        return self

    def weights(self, found: dict[int, int]) -> tuple[list[int], list[float]]:
        """Terms and normalised TF-IDF weights of a text's term counts."""
        terms = sorted(found)
        w = (1 + np.log([found[t] for t in terms])) * self.idf[terms] if terms else np.zeros(0)
        norm = np.sqrt((w * w).sum())
        return terms, (w / norm if norm else w).tolist()

    def nearest(self, terms: list[int], weights: list[float], k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Rows and similarities of the k nearest examples of positive similarity."""
        none = np.zeros(0, np.int64), np.zeros(0)
        if not terms or not len(self.ids):
            return none
        bounds = np.asarray(weights) @ self.most[terms]
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        rows, sims = none

        def merge(here: np.ndarray, found: np.ndarray) -> None:
            nonlocal rows, sims
            some = (found > 0) & (here != without)
            rows, sims = np.concatenate([rows, here[some]]), np.concatenate([sims, found[some]])
            best = np.lexsort((rows, -sims))[:k]
            rows, sims = rows[best], sims[best]

        for visited, b in enumerate(order):
            # Rounding may put a bound just below the similarity it bounds.
            least = sims[-1] / (1 + 1e-9) if len(sims) == k else 0.0
            if bounds[b] < least:
                break
            if visited < FEW:
                score = np.zeros(BLOCK)
                for t, w in zip(terms, weights, strict=True):
                    at, values = self.postings[t]
                    part = slice(self.cuts[t, b], self.cuts[t, b + 1])
                    score[at[part] - b * BLOCK] += w * values[part]
                merge(np.arange(BLOCK) + b * BLOCK, score)
                continue
            # Many blocks left: add up whole postings, then take those of blocks in question.
            score = np.zeros(len(bounds) * BLOCK)
            for t, w in zip(terms, weights, strict=True):
                at, values = self.postings[t]
                score[at] += w * values
            left = order[visited:][bounds[order[visited:]] >= least]
            here = (left[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            here = here[score[here] >= least]
            merge(here, score[here])
            break
        return rows, sims

    def vote(self, rows: np.ndarray, sims: np.ndarray) -> float:
        return float(((sims * self.toxic[rows]).sum() + SMOOTHING * self.base) / (sims.sum() + SMOOTHING))

    def calibrate(self, counts: list[dict[int, int]], k: int) -> BlockMaxIndex:
        """Isotonic regression (pool adjacent violators) of labels on leave-one-out votes."""
        votes = np.array([self.vote(*self.nearest(*self.weights(c), k, row)) for row, c in enumerate(counts)])
        at, group = np.unique(votes, return_inverse=True)
        sums = np.bincount(group, self.toxic, minlength=len(at))
        sizes = np.bincount(group, minlength=len(at)).astype(float)
        pools: list[list[float]] = []
        for x, s, n in zip(at, sums, sizes, strict=True):
            pools.append([x, x, s, n])
            while len(pools) > 1 and pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3]:
                _, high, s2, n2 = pools.pop()
                pools[-1] = [pools[-1][0], high, pools[-1][2] + s2, pools[-1][3] + n2]
        if pools:
            xs = np.array([x for p in pools for x in p[:2]])
            ys = np.array([p[2] / p[3] for p in pools for _ in range(2)])
            self.knots = (xs, ys)
        return self

    def score(self, rows: np.ndarray, sims: np.ndarray) -> float:
        return float(np.interp(self.vote(rows, sims), *self.knots)) if self.knots else 0.0


def _example_words(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """Words of every example: ``doc_id``, ``toxic``, ``word``, ``n``."""
    texts = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    )

    def cut(batches):
        for batch in batches:
            ids, labels, words, counts = [], [], [], []
            for doc, label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2)), strict=True):
                found = Counter()
                for word, n in Counter(words_of(text)).items():
                    for term in terms_of(word):
                        found[term] += n
                for term, n in [(b"", 0), *with_repeats(found).items()]:
                    ids.append(doc)
                    labels.append(label)
                    words.append(term.decode("utf-8", "replace"))
                    counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(labels, pa.int32()), pa.array(words, pa.string()), pa.array(counts, pa.int32())],
                names=["doc_id", "toxic", "word", "n"],
            )

    return texts.mapInArrow(cut, "doc_id bigint, toxic int, word string, n int")


def fit(
    docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, terms: int = TERMS, k: int = NEIGHBOURS
) -> BlockMaxIndex:
    """The calibrated index of a bounded sample of labelled documents."""
    labelled = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    sample = saved(labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples), "toxicity_sample")
    # The empty word stands for each example itself, so that all are kept.
    words = saved(_example_words(docs, sample), "toxicity_words")
    total = words.where("word = ''").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("hot")
    ).first()
    a, b = F.col("a"), F.col("df") - F.col("a")
    c, d = F.lit(total.hot) - a, F.lit(total.n - total.hot) - b
    margins = (a + b) * (c + d) * F.lit(max(total.hot, 1)) * F.lit(max(total.n - total.hot, 1))
    chosen = (
        words.where("word != ''")
        .groupBy("word")
        .agg(F.count("*").cast("double").alias("df"), F.sum("toxic").cast("double").alias("a"))
        .where(F.col("df") >= DF)
        .withColumn("chi", F.lit(float(total.n)) * F.pow(a * d - b * c, 2) / F.when(margins > 0, margins))
        .where(F.col("chi") >= CHI * total.n)
        .orderBy(F.desc("chi"), "word")
        .limit(terms)
    )
    vocabulary = [(r.word.encode(), r.df) for r in chosen.select("word", "df").collect()]  # at most ``terms``
    at = {w: i for i, (w, _) in enumerate(vocabulary)}
    idf = np.log((1 + total.n) / (1 + np.array([df for _, df in vocabulary]))) + 1
    kept = words.join(F.broadcast(chosen.select("word")), "word", "left_semi").unionByName(words.where("word = ''"))
    # At most ``examples`` x ``terms`` small integers; in practice a handful an example.
    gathered = (
        kept.groupBy("doc_id", "toxic")
        .agg(F.collect_list(F.struct("word", "n")).alias("found"))
        .orderBy("doc_id")
        .collect()
    )
    counts = [{at[f.word.encode()]: f.n for f in r.found if f.word} for r in gathered]
    ids = np.array([r.doc_id for r in gathered], np.int64)
    toxic = np.array([r.toxic for r in gathered], np.int64)
    return BlockMaxIndex(at, idf, ids, toxic).build(counts).calibrate(counts, k)


def with_scores(docs: DataFrame, index: BlockMaxIndex, text: str = "text", k: int = NEIGHBOURS) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``evidence``, the nearest examples."""
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def start():
        release_kept()
        found = sent.value
        known = KnownTerms(found.terms)
        # Short vectors repeat: many texts hold one or two terms.
        seen: dict[tuple, tuple] = {}

        def nearest(terms: list[int], weights: list[float]) -> tuple[np.ndarray, np.ndarray]:
            if len(terms) > 2:
                return found.nearest(terms, weights, k)
            key = (*terms, *weights)
            if key not in seen:
                if len(seen) >= 10_000:
                    seen.clear()
                seen[key] = found.nearest(terms, weights, k)
            return seen[key]

        def step(texts: pa.Array) -> list[pa.Array]:
            scores, evidence = [], []
            for raw in text_bytes(texts):
                rows, sims = nearest(*found.weights(known.counts(words_of(raw))))
                scores.append(found.score(rows, sims))
                evidence.append(
                    [
                        {"doc_id": int(found.ids[r]), "similarity": float(s), "toxic": int(found.toxic[r])}
                        for r, s in zip(rows, sims, strict=True)
                    ]
                )
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))
            return [pa.array(scores, pa.float64()), pa.array(evidence, kind)]

        return step

    return with_scanned(docs, text, FIELDS, start)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = with_scores(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
    )


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rejected ones; columns as before."""
    scored = with_scores(docs, fit(docs, labels))
    return scored.where(F.col("score") < REJECT).select(docs.columns)
