"""Benchmark decontamination: a broadcast hash set of benchmark n-grams against whole texts.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z. Every
``n`` consecutive words of a benchmark item are a window; an item of fewer words, but not
none, is one window. A document word inside any occurrence of a window is hit.

The windows are gathered in shares of at most ``share`` (their number is counted first) and
each share is broadcast; documents pass through one map per share and are never shuffled.
A candidate start is a run of benchmark words that opens like a window; it counts only
after the window itself has been found in the hash set.

Defined cases: null texts and items have no words; null item ids hit but are not listed;
repeated items count once by id; an empty benchmark hits nothing; result columns replace
input columns of the same name; repeated documents give repeated rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import release_kept, text_bytes, with_scanned, without

#: Bytes of words as they are, A-Z in lower case, everything else a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
WINDOW = 10
#: Windows in one broadcast: about 100 bytes each, so at most some 50 MB.
SHARE = 500_000

SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("hit_words", T.ArrayType(T.IntegerType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """One row per distinct window and item: ``win`` (words joined by spaces), ``item``."""
    schema = T.StructType([T.StructField("win", T.StringType()), T.StructField("item", T.StringType())])

    def cut(batches):
        for batch in batches:
            wins, items = [], []
            for item, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                words = words_of(text)
                for i in range(max(1, len(words) - n + 1) if words else 0):
                    wins.append(b" ".join(words[i : i + n]).decode("utf-8", "surrogatepass"))
                    items.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(wins, pa.string()), pa.array(items, pa.string())], names=schema.names)

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, schema).distinct()


class WindowSet:
    """Hash set of windows, with the word ids and opening word pairs that find candidates."""

    def __init__(self, rows: list[tuple[str, str | None]]):
        self.items: dict[bytes, set[str]] = defaultdict(set)
        for win, item in rows:
            found = self.items[win.encode()]
            if item is not None:
                found.add(item)
        self.items = dict(self.items)
        split = [w.split(b" ") for w in self.items]
        self.ids = {w: i for i, w in enumerate({w for words in split for w in words})}
        self.base = len(self.ids) + 1
        opens: dict[int, set[int]] = defaultdict(set)
        for words in split:
            opens[len(words)].add(self.opening(words))
        self.opens = {k: np.array(sorted(v), dtype=np.int64) for k, v in opens.items()}

    def opening(self, words: list[bytes]) -> int:
        first = self.ids[words[0]]
        return first if len(words) == 1 else first * self.base + self.ids[words[1]]

    def scan(self, words: list[bytes], hit: np.ndarray, items: set[str]) -> None:
        """Mark the words of ``hit`` inside occurring windows and add those windows' items."""
        count = len(words)
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, count)
        known = ids >= 0
        if not known.any():
            return
        ends = np.where(known, count, np.arange(count))
        run = np.minimum.accumulate(ends[::-1])[::-1] - np.arange(count)
        for length, opens in self.opens.items():
            starts = np.flatnonzero(run >= length)
            if not len(starts):
                continue
            code = ids[starts] if length == 1 else ids[starts] * self.base + ids[starts + 1]
            at = np.minimum(np.searchsorted(opens, code), len(opens) - 1)
            for i in starts[opens[at] == code].tolist():
                found = self.items.get(b" ".join(words[i : i + length]))
                if found is not None:
                    hit[i : i + length] = True
                    items |= found


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = WINDOW, share: int = SHARE) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_words`` (positions) and ``items`` (ids, sorted)."""
    spark = docs.sparkSession
    # One scan of the windows per share: pmod of a hash deals them evenly.
    wins = windows(benchmark, n)
    shares = max(1, -(-wins.count() // share))
    out = without(docs, FIELDS.names)
    for k in range(shares):
        part = wins.where(F.pmod(F.xxhash64("win"), F.lit(shares)) == k)
        sent = spark.sparkContext.broadcast(WindowSet([tuple(r) for r in part.collect()]))

        def start(sent=sent):
            release_kept()
            found = sent.value

            def step(texts: pa.Array) -> list[pa.Array]:
                totals, hits, spots, names = [], [], [], []
                for raw in text_bytes(texts):
                    words = words_of(raw)
                    hit = np.zeros(len(words), bool)
                    items: set[str] = set()
                    if words and found.items:
                        found.scan(words, hit, items)
                    spot = np.flatnonzero(hit).tolist()
                    totals.append(len(words))
                    hits.append(len(spot))
                    spots.append(spot)
                    names.append(sorted(items))
                return [
                    pa.array(totals, pa.int64()),
                    pa.array(hits, pa.int64()),
                    pa.array(spots, pa.list_(pa.int32())),
                    pa.array(names, pa.list_(pa.string())),
                ]

            return step

        fields = FIELDS if k == 0 else T.StructType([T.StructField(f"_{f.name}", f.dataType) for f in FIELDS])
        out = with_scanned(out, text, fields, start)
        if k:
            spots = F.array_sort(F.array_union("hit_words", "_hit_words"))
            names = F.array_sort(F.array_union("items", "_items"))
            out = (
                out.withColumn("hit_words", spots)
                .withColumn("items", names)
                .withColumn("n_hit", F.size("hit_words").cast("long"))
                .drop(*fields.names)
            )
    return out


def digest(scanned: DataFrame) -> DataFrame:
    """Columns of the report: counts, the digest of the item list, the verdict."""
    return (
        scanned.withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def drop_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated ones; columns as before."""
    return scan(docs, benchmark, text, n).where("n_hit = 0").select(docs.columns)


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = WINDOW) -> DataFrame:
    """``docs`` with every run of hit words cut out of the text; columns as before."""
    scanned = scan(docs, benchmark, text, n)
    at, spots = scanned.columns.index(text), scanned.columns.index("hit_words")
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == text else f.dataType) for f in scanned.schema])

    def cut(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for row, hit in enumerate(batch.column(spots).to_pylist()):
                if hit:
                    bounds = [m.span() for m in _WORD.finditer(texts[row])]
                    kept, last, previous = [], 0, -2
                    for i in hit:
                        if i != previous + 1:
                            kept.append(texts[row][last : bounds[i][0]])
                        last, previous = bounds[i][1], i
                    texts[row] = "".join([*kept, texts[row][last:]])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return scanned.mapInArrow(cut, schema).select(docs.columns)


