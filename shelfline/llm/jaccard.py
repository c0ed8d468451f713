"""N-gram Jaccard join: documents whose sets of word shingles are at least 80 % alike.

Exact, in five steps; the sets themselves travel only for documents in question.

1. *Order.* Shingles are ordered by hash, those that many documents of a sample hold last.
   Any order gives the same links; this one keeps shared passages and lines out of the keys.
2. *Blocks.* Two sets of similarity 0.8 share one of their first n - ceil(0.8 n) + 1
   shingles, so documents meet at the keys of these prefixes. Keys of a single set are dropped
   by the least and the greatest set id of each key (map-side combined); exact copies have one
   set id.
3. *Stars.* At each key every set is compared with the least one: by size, by bitmap, and
   exactly where these leave it open. That links the bulk of large groups of near copies
   with one comparison a set, not one a pair.
4. *Signature trees.* Keys whose sets are still in several components are searched for the
   remaining links: sets are leaves of a tree whose nodes hold the OR of token bitmaps and
   the range of sizes. A dual traversal drops node pairs whose maximum possible overlap
   cannot reach 80 %, or whose pairs are linked already; wider bitmaps of the single sets
   drop most others. What is left in question, over all keys, falls into small circles of
   sets, which are searched by such trees again, now with the sets themselves, each sent
   once. A row joins two components, so no search returns as many rows as it has sets. Keys of more than ``KEY_HASHES``
   shingles in all are dealt as pairs of blocks over many tasks, before they are shuffled.
5. *Components* of all links, by alternating large and small stars.

Words are runs of non-white ASCII space after lower-casing A-Z, shingles five of them; a
text of fewer words is one shingle. Shingles are compared by 64-bit hashes.

Defined cases: null texts and texts without words have 0 shingles and are linked with
nothing; equal sets are linked; rows of the same doc_id are separate documents of that id; null ids
take no part in the smallest id of a component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import discard, release_kept, saved, text_bytes, trim, with_scanned

SHINGLE = 5
PERCENT = 80
#: Bits of a set in the nodes of the tree, and of the widest bitmap kept of a set.
BITS, MOST_BITS = 1_024, 16_384
CACHE = 200_000
#: Texts cut at once.
TEXTS = 1_000
#: Shingles of all sets, and sets, at one key that one task searches; more are split into
#: pairs of blocks.
KEY_HASHES, KEY_SETS = 2_000_000, 4_096
#: Share of the documents that order shingles (one in so many), documents of it that make a
#: shingle frequent, and most frequent shingles kept (8 bytes each, sent to all tasks).
SAMPLED, OFTEN, MOST_OFTEN = 8, 3, 1 << 18
#: Sets compared with one centre in one task.
STAR_ROWS = 1_000
#: Set ids sent to all tasks to pick the sets in question (8 bytes each).
SENT_IDS = 4_000_000
LEAF, FANOUT = 32, 8
#: Node pairs taken apart at once, and pairs of sets.
PART, SETS_PART = 64, 4_096

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SET_FIELDS = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_id", T.LongType()),
        T.StructField("bits", T.BinaryType()),
        T.StructField("text_id", T.LongType()),
        T.StructField("prefix", T.ArrayType(T.LongType())),
    ]
)


class Shingler:
    """Sorted shingle hashes of texts, with a cache of word hashes."""

    def __init__(self, size: int = SHINGLE):
        self.size = size

        class Words(dict):
            def __missing__(self, word: bytes) -> int:
                if len(self) >= CACHE:
                    self.clear()
                found = self[word] = xxhash.xxh3_64_intdigest(word)
                return found

        self.words = Words()

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.translate(LOWER).split()
        if not words:
            return np.zeros(0, np.uint64)
        size = min(self.size, len(words))
        each = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        count = len(words) - size + 1
        found = np.full(count, size, np.uint64)
        for k in range(size):
            found = found * np.uint64(0x9E3779B97F4A7C15) + each[k : k + count]
        found ^= found >> np.uint64(31)
        found *= np.uint64(0xBF58476D1CE4E5B9)
        return np.unique(found ^ (found >> np.uint64(29)))


def set_id(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


NONE = np.zeros(0, np.uint64)


def prefix(hashes: np.ndarray, percent: int = PERCENT, last: np.ndarray = NONE) -> np.ndarray:
    """The first shingles in order of hash, those in ``last`` (rising) after all others."""
    n = len(hashes)
    size = n - -(-n * percent // 100) + 1
    if len(last):
        often = last[np.minimum(np.searchsorted(last, hashes), len(last) - 1)] == hashes
        hashes = np.concatenate([hashes[~often], hashes[often]])
    return hashes[:size]


def frequent(texts: DataFrame) -> np.ndarray:
    """Shingles (rising) that several documents of a sample hold; at most ``MOST_OFTEN``.

    Tasks report what they have met more than once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        shingle, held, size = Shingler(), [], 0

        def told() -> pa.RecordBatch:
            hashes, n = np.unique(np.concatenate(held) if held else NONE, return_counts=True)
            some = n > 1
            return pa.RecordBatch.from_arrays([pa.array(hashes[some].view(np.int64)), pa.array(n[some])], names=["hash", "n"])

        for batch in batches:
            for raw in _texts(batch):
                held.append(shingle(raw))
                size += len(held[-1])
                if size > 1 << 21:
                    yield told()
                    held, size = [], 0
        yield told()

    some = texts.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0)
    counts = some.mapInArrow(run, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "hash").limit(MOST_OFTEN).select("hash").toArrow()
    return np.sort(np.array(top["hash"].to_pylist(), np.int64).view(np.uint64))


def alike(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    low, high = sorted((len(a), len(b)))
    if 100 * low < percent * high:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def wide_bitmap(hashes: np.ndarray) -> np.ndarray:
    """Four bits or more a hash, within ``BITS`` and ``MOST_BITS``; it folds to fewer bits."""
    size = min(MOST_BITS, max(BITS, 1 << (4 * len(hashes) - 1).bit_length()))
    bits = np.zeros(size, np.uint8)
    bits[(hashes % np.uint64(size)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (the last axis) of the same hashes in ``words`` words of 64 bits."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def may_be_alike(n: int, a: np.ndarray, m: int, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether the bits common to two bitmaps, with the smaller excess, allow it."""
    a, b = folded(a, len(b)), folded(b, len(a))
    excess = min(n - int(np.bitwise_count(a).sum()), m - int(np.bitwise_count(b).sum()))
    overlap = min(int(np.bitwise_count(a & b).sum()) + excess, n, m)
    return (100 + percent) * overlap >= percent * (n + m)


class SignatureTree:
    """Levels of nodes over sets in order of size: OR-combined bitmaps, sizes, most excess.

    A set's excess is its size less its number of bits. Two sets overlap in at most the
    bits common to them plus the smaller excess.
    """

    def __init__(self, sizes: np.ndarray, bitmaps: np.ndarray):
        excess = sizes - np.bitwise_count(bitmaps).sum(axis=1).astype(np.int64)
        self.levels = [(bitmaps, sizes, sizes, excess)]
        step = LEAF
        while len(self.levels[-1][0]) > 1:
            below, low, high, most = self.levels[-1]
            cuts = np.arange(0, len(below), step)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(below, cuts, axis=0),
                    np.minimum.reduceat(low, cuts),
                    np.maximum.reduceat(high, cuts),
                    np.maximum.reduceat(most, cuts),
                )
            )
            step = FANOUT

    def possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Which node pairs may hold a pair of sets that is alike."""
        bits, low, high, most = self.levels[level]
        common = np.bitwise_count(bits[a] & bits[b]).sum(axis=1).astype(np.int64)
        overlap = np.minimum(common + np.minimum(most[a], most[b]), np.minimum(high[a], high[b]))
        # alike: 100 I >= p (A + B - I), so (100 + p) I >= p (A + B)
        enough = (100 + percent) * overlap >= percent * (low[a] + low[b])
        sizes = (100 * high[a] >= percent * low[b]) & (100 * high[b] >= percent * low[a])
        return enough & sizes

    def pairs(self, percent: int = PERCENT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Dual traversal from the root; yields rows of sets that may be alike, in parts."""
        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            most = SETS_PART if level == 0 else PART
            if len(a) > most:
                # The rest waits, so that no more than one part of a level is ever spread out.
                stack.append((level, a[most:], b[most:]))
                a, b = a[:most], b[:most]
            if level == 0:
                a, b = a[a != b], b[a != b]
            some = self.possible(level, a, b, percent)
            x, y = a[some], b[some]
            if not len(x):
                continue
            if level == 0:
                yield x, y
                continue
            step = LEAF if level == 1 else FANOUT
            below = len(self.levels[level - 1][0])
            i, j = np.divmod(np.arange(step * step), step)
            x2 = (x[:, None] * step + i).ravel()
            y2 = (y[:, None] * step + j).ravel()
            inside = (x2 < below) & (y2 < below) & (x2 <= y2)
            stack.append((level - 1, x2[inside], y2[inside]))


def bitmap(hashes: np.ndarray) -> np.ndarray:
    return folded(wide_bitmap(hashes), BITS // 64)


class WideBitmaps:
    """Bitmaps of different widths, to test many pairs of sets at the lesser width of each pair."""

    def __init__(self, sizes: np.ndarray, bitmaps: list[np.ndarray]):
        self.sizes, self.bitmaps = sizes, bitmaps
        self.words = np.array([len(b) for b in bitmaps])
        self.kept: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def _at(self, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, bitmap and excess of each set of at least ``words`` words."""
        if words not in self.kept:
            some = np.flatnonzero(self.words >= words)
            bits = np.stack([folded(self.bitmaps[k], words) for k in some])
            place = np.full(len(self.words), -1)
            place[some] = np.arange(len(some))
            excess = self.sizes[some] - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
            self.kept[words] = place, bits, excess
        return self.kept[words]

    def shares(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The most that the overlap of each pair can be, by the sum of both sizes."""
        out = np.zeros(len(i))
        words = np.minimum(self.words[i], self.words[j])
        for width in np.unique(words):
            place, bits, excess = self._at(int(width))
            some = words == width
            a, b = place[i[some]], place[j[some]]
            common = np.bitwise_count(bits[a] & bits[b]).sum(axis=1).astype(np.int64)
            n, m = self.sizes[i[some]], self.sizes[j[some]]
            most = np.minimum(common + np.minimum(excess[a], excess[b]), np.minimum(n, m))
            out[some] = most / (n + m)
        return out


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    """The texts in the first column, some at a time."""
    for start in range(0, batch.num_rows, TEXTS):
        yield from text_bytes(batch.column(0).slice(start, TEXTS))


def text_id(raw: bytes) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(raw), "little", signed=True)


def with_set_ids(docs: DataFrame, text: str = "text", percent: int = PERCENT, last: np.ndarray = NONE) -> DataFrame:
    """``docs`` with ``n_shingles``, ``set_id``, ``bits``, ``text_id`` and ``prefix`` (null without words)."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
    sent = docs.sparkSession.sparkContext.broadcast(last)

    def start():
        release_kept()
        shingle, last, told = Shingler(), sent.value, set()

        def described(raw: bytes) -> tuple:
            found = shingle(raw)
            if not len(found):
                return 0, None, None, None, None
            name, bits = set_id(found), wide_bitmap(found).tobytes()
            # Copies meet by their set; the keys of one of them in a task are enough.
            keys = None if name in told else prefix(found, percent, last).view(np.int64)
            told.add(name)
            return len(found), name, bits, text_id(raw), keys

        def step(texts: pa.Array) -> list[pa.Array]:
            parts = []
            for start in range(0, len(texts), TEXTS):
                rows = [described(t) for t in text_bytes(texts.slice(start, TEXTS))]
                parts.append([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)])
            return [pa.concat_arrays([p[i] for p in parts]) if parts else pa.array([], k) for i, k in enumerate(kinds)]

        return step

    return with_scanned(docs, text, SET_FIELDS, start)


def _sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row for each wanted set: ``set_id``, ``n`` and ``payload``, the bytes of its hashes.

    ``wanted`` names one text of each set, so that no other text is cut into shingles.
    """
    ids = None
    if wanted.count() <= SENT_IDS:
        ids = texts.sparkSession.sparkContext.broadcast(
            np.sort(np.array([r[0] for r in wanted.select("text_id").toLocalIterator()], np.int64))
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, told = Shingler(), set()
        for batch in batches:
            rows, held = [], 0
            for raw in _texts(batch):
                if ids is not None:
                    name = text_id(raw)
                    at = np.searchsorted(ids.value, name)
                    if at == len(ids.value) or ids.value[at] != name or name in told:
                        continue
                    told.add(name)
                found = shingle(raw)
                if not len(found):
                    continue
                rows.append((set_id(found), len(found), found.tobytes()))
                held += len(found)
                if held > 1 << 19:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)
        del shingle
        trim()

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["set_id", "n", "payload"])

    found = texts.mapInArrow(run, "set_id bigint, n bigint, payload binary")
    if ids is None:
        found = found.join(wanted.select("set_id"), "set_id", "left_semi")
    return found.dropDuplicates(["set_id"])


def _compared(pairs: DataFrame, payloads: DataFrame, test: Callable[[int, bytes, int, bytes], bool]) -> DataFrame:
    """The pairs (``centre``, ``set_id``) whose sizes and payloads pass ``test``.

    Sets stream past their centre; a centre of many sets is repeated over several splits.
    """
    counts = pairs.groupBy("centre").agg(F.ceil(F.count("*") / STAR_ROWS).cast("int").alias("splits"))
    split = F.pmod(F.xxhash64("set_id"), F.col("splits")).cast("int")
    members = pairs.join(counts, "centre").select("centre", split.alias("split"), F.lit(1).alias("nth"), "set_id")
    centres = counts.select("centre", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split")).select(
        "centre", "split", F.lit(0).alias("nth"), F.col("centre").alias("set_id")
    )
    rows = (
        members.unionByName(centres)
        .join(payloads, "set_id")
        .select("centre", "split", "nth", "set_id", "n", "payload")
        .repartition("centre", "split")
        .sortWithinPartitions("centre", "split", "nth")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, against = None, (0, b"")
        for batch in batches:
            left, right = [], []
            for c, _, nth, mine, n, raw in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if nth == 0:
                    centre, against = c, (n, raw)
                elif centre == c and test(n, raw, *against):
                    left.append(c)
                    right.append(mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["centre", "set_id"]
            )

    return rows.mapInArrow(run, "centre bigint, set_id bigint")


def _plausible(star: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and bitmaps allow them to be alike."""
    sizes = signs.select("set_id", "n")
    sized = (
        star.join(sizes.select("set_id", F.col("n").alias("own")), "set_id")
        .join(sizes.select(F.col("set_id").alias("centre"), F.col("n").alias("against")), "centre")
        .where(F.least("own", "against") * 100 >= F.greatest("own", "against") * percent)
        .select("centre", "set_id")
    )

    def test(n: int, raw: bytes, m: int, other: bytes) -> bool:
        return may_be_alike(n, np.frombuffer(raw, np.uint64), m, np.frombuffer(other, np.uint64), percent)

    return _compared(saved(sized, "jaccard_sized"), signs.select("set_id", "n", F.col("bits").alias("payload")), test)


def _wanted(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    ids = pairs.select("centre").union(pairs.select("set_id")).toDF("set_id").distinct()
    return saved(ids.join(signs.select("set_id", "text_id"), "set_id"), "jaccard_wanted")


def _distinct_keys(members: DataFrame, *by: str) -> DataFrame:
    """``members`` with one key of those at which the same sets meet: a shared passage has many."""
    name = F.xxhash64("set_id")
    met = members.groupBy(*by).agg(
        F.min("set_id").alias("low"),
        F.count("*").alias("rows"),
        F.sum(name.bitwiseAND(0xFFFFFFFF)).alias("sum_low"),
        F.sum(F.shiftrightunsigned(name, 32)).alias("sum_high"),
    )
    kept = met.groupBy("low", "rows", "sum_low", "sum_high").agg(F.min(F.struct(*by)).alias("kept"))
    return members.join(kept.select("kept.*"), list(by), "left_semi")


def _links(pairs: DataFrame, texts: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are alike: ``a``, ``b``."""

    def same(n: int, raw: bytes, m: int, other: bytes) -> bool:
        return alike(np.frombuffer(raw, np.uint64), np.frombuffer(other, np.uint64), percent)

    return _compared(pairs, _sets(texts, _wanted(pairs, signs)), same).toDF("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is linked to, for every node in ``links``.

    Rounds go on until nothing changes; a round's tables go when the next is written.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "jaccard_edges")
    before, now = None, _told(edges)
    while now != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.where("u != v").distinct(), "jaccard_edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        old, edges = edges, saved(small, "jaccard_edges")
        discard(old, large)
        before, now = now, _told(edges)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = saved(roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), "jaccard_roots")
    discard(edges)
    return out


def _told(edges: DataFrame) -> tuple:
    """What tells one set of edges from another."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _open(members: DataFrame, roots: DataFrame, signs: DataFrame) -> DataFrame:
    """``key``, ``x``, ``y``, ``block``, ``set_id``, ``root`` of the sets at keys of several components.

    ``x`` and ``y`` are a pair of blocks that are searched together. Hot keys are few, as each
    holds ``KEY_HASHES`` shingles; they are told to all tasks, so that the sets at them are
    dealt by blocks without meeting at the key first.
    """
    sized = members.join(signs.select("set_id", "n"), "set_id")
    placed = sized.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "key", "set_id", "n", F.coalesce("root", "set_id").alias("root")
    )
    placed = saved(placed, "jaccard_placed")
    keys = placed.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.greatest(F.sum("n") / KEY_HASHES, F.count("*") / KEY_SETS)).cast("int").alias("blocks"),
    )
    keys = saved(keys.where("low != high").select("key", "blocks"), "jaccard_open")
    hot = keys.where("blocks > 1")
    mine = F.pmod(F.xxhash64("set_id", "key"), F.col("blocks")).cast("int")
    spread = (
        placed.join(F.broadcast(hot), "key")
        .withColumn("block", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "set_id", "root")
    )
    zero = F.lit(0)
    # Sets at hot keys leave before the others are shuffled by key.
    cool = placed.join(F.broadcast(hot), "key", "left_anti").join(keys.where("blocks = 1"), "key", "left_semi")
    cool = cool.select("key", zero.alias("x"), zero.alias("y"), zero.alias("block"), "set_id", "root")
    return spread.unionByName(cool)


class Joined:
    """Which of some roots have been joined."""

    def __init__(self, size: int):
        self.up = np.arange(size)

    def of(self, at: np.ndarray) -> np.ndarray:
        found = self.up[at]
        while (self.up[found] != found).any():
            found = self.up[found]
        self.up[at] = found
        return found

    def join(self, a: int, b: int) -> None:
        self.up[max(a, b)] = min(a, b)


class Group:
    """Sets at a key (or a pair of its blocks), rising in size, with bitmaps to rule out pairs."""

    def __init__(self, sizes: np.ndarray, bitmaps: list[np.ndarray], root: np.ndarray, block: np.ndarray | None = None):
        self.wide = WideBitmaps(sizes, bitmaps)
        self.tree = SignatureTree(sizes, np.stack([folded(b, BITS // 64) for b in bitmaps]))
        self.root, self.block = np.unique(root, return_inverse=True)[1], block
        self.joined = Joined(len(sizes))

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs are of different components (and blocks)."""
        some = self.joined.of(self.root[i]) != self.joined.of(self.root[j])
        return some if self.block is None else some & (self.block[i] != self.block[j])

    def possible(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs that bitmaps do not rule out, in parts, the most alike of a part first."""
        for i, j in self.tree.pairs(percent):
            some = self.apart(i, j)
            i, j = i[some], j[some]
            share = self.wide.shares(i, j)
            # alike: 100 I >= p (A + B - I); the share is rounded, so a little less will do
            near = np.flatnonzero((100 + percent) * share >= percent - 1e-6)
            near = near[np.argsort(-share[near], kind="stable")]
            yield i[near], j[near]

    def plausible(self, percent: int = PERCENT) -> list[tuple[int, int]]:
        """Pairs that join all sets which possible pairs join, one for each joining."""
        met, out = Joined(len(self.root)), []
        for i, j in self.possible(percent):
            while True:
                new = np.flatnonzero(met.of(i) != met.of(j))
                if not len(new):
                    break
                i, j = i[new], j[new]
                a, b = met.of(np.array([i[0], j[0]]))
                met.join(a, b)
                out.append((int(i[0]), int(j[0])))
        return out

    def links(self, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
        """Pairs that are alike, each of which joins two components."""
        out = []
        for i, j in self.possible(percent):
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                a, b = self.joined.of(self.root[[x, y]])
                if a != b and alike(sets[x], sets[y], percent):
                    self.joined.join(a, b)
                    out.append((x, y))
        return out


def _by_group(
    dealt: DataFrame, sets: DataFrame, layout: str, found: Callable[[list[tuple]], list[tuple]]
) -> DataFrame:
    """What ``found`` makes of the sets of every key and pair of blocks, rising in size.

    Rows are ``key``, ``x``, ``y``, ``n``, ``set_id``, ``root``, ``block``, ``payload``.
    """
    rows = (
        dealt.join(sets, "set_id")
        .select("key", "x", "y", "n", "set_id", "root", "block", "payload")
        .repartition("key", "x", "y")
        .sortWithinPartitions("key", "x", "y", "n", "set_id")
    )
    kinds = [c.split()[0] for c in layout.split(", ")]

    def told(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {c: pa.array([r[k] for r in out], pa.int64()) for k, c in enumerate(kinds)}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        group: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            columns = [c.to_pylist() for c in batch.columns[:7]]
            for k, row in enumerate(zip(*columns, strict=True)):
                if group and row[:3] != group[0][:3]:
                    out += searched(group)
                    group = []
                group.append((*row, batch.column(7)[k].as_py()))
            yield told(out)
        yield told(searched(group) if group else [])
        group.clear()
        trim()

    def searched(group: list[tuple]) -> list[tuple]:
        return [] if all(r[5] == group[0][5] for r in group) else found(group)

    return rows.mapInArrow(run, layout)


def _group(rows: list[tuple], bitmaps: list[np.ndarray]) -> Group:
    block = np.array([r[6] for r in rows]) if rows[0][1] != rows[0][2] else None
    return Group(np.array([r[3] for r in rows], np.int64), bitmaps, np.array([r[5] for r in rows], np.int64), block)


def _in_question(dealt: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) that join what bitmaps leave in question at each key."""

    def found(rows: list[tuple]) -> list[tuple]:
        group = _group(rows, [np.frombuffer(r[7], np.uint64) for r in rows])
        return [(rows[i][4], rows[j][4]) for i, j in group.plausible(percent)]

    return _by_group(dealt, signs.select("set_id", "n", F.col("bits").alias("payload")), "a bigint, b bigint", found).distinct()


def _search(dealt: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (``a``, ``b``) between components, found where the sets of a key lie."""

    def found(rows: list[tuple]) -> list[tuple]:
        sets = [np.frombuffer(r[7], np.uint64) for r in rows]
        links = _group(rows, [wide_bitmap(s) for s in sets]).links(sets, percent)
        return [(rows[i][4], rows[j][4]) for i, j in links]

    return _by_group(dealt, sets, "a bigint, b bigint", found).distinct()


def join(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every document.

    Shingles are kept as bitmaps and prefixes; only texts in question are cut again.
    """
    texts = docs.select(F.col(text).cast("string").alias("text"))
    whole = docs.select("doc_id", F.col(text).cast("string").alias("text"))
    base = saved(with_set_ids(whole, "text", percent, frequent(texts)).drop("text"), "jaccard_base")
    keys = base.where("set_id IS NOT NULL").select(F.explode("prefix").alias("key"), "set_id")
    # Dealt by key once; extents and members of the keys both read that exchange.
    keys = keys.repartition("key")
    shared = keys.groupBy("key").agg(F.min("set_id").alias("centre"), F.max("set_id").alias("last"))
    met = saved(keys.join(shared.where("centre != last").drop("last"), "key").distinct(), "jaccard_members")
    members = saved(_distinct_keys(met, "key"), "jaccard_members")
    discard(met)
    signs = base.where("set_id IS NOT NULL").groupBy("set_id").agg(
        F.max("n_shingles").alias("n"), F.max("bits").alias("bits"), F.min("text_id").alias("text_id")
    )
    signs = saved(signs.join(members.select("set_id").distinct(), "set_id", "left_semi"), "jaccard_signs")
    star = members.where("set_id != centre").select("centre", "set_id").distinct()
    plausible = saved(_plausible(star, signs, percent), "jaccard_pairs")
    links = saved(_links(plausible, texts, signs, percent), "jaccard_links")
    roots = components(links)
    # The centre of a key has been compared with all sets there.
    dealt = saved(_open(members.where("set_id != centre"), roots, signs), "jaccard_dealt")
    asked = saved(_in_question(dealt, signs, percent), "jaccard_asked")
    discard(members, plausible, dealt)
    if not asked.isEmpty():
        # Sets in question with each other, over all keys: each is sent once, or once a block.
        circles = components(asked).select(F.col("root").alias("key"), F.col("node").alias("set_id"))
        dealt = saved(_open(circles, roots, signs), "jaccard_dealt")
        wanted = dealt.select("set_id").distinct().join(signs.select("set_id", "text_id"), "set_id")
        more = _search(dealt, _sets(texts, saved(wanted, "jaccard_wanted")), percent)
        more = saved(links.unionByName(more), "jaccard_links")
        discard(roots, links, dealt)
        links, roots = more, components(more)
    discard(asked)
    roots = roots.withColumnRenamed("node", "set_id")
    first = base.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    # Only sets with copies or links need a look-up; all other documents stand alone.
    rooted = first.join(roots, "set_id", "left").where("n > 1 OR root IS NOT NULL")
    rooted = saved(rooted.select("set_id", "first", F.coalesce("root", "set_id").alias("root")), "jaccard_rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    found = rooted.join(least, "root").select("set_id", "least")
    return base.join(found, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


def representatives(docs: DataFrame, text: str = "text") -> DataFrame:
    """One document of each component: that with the smallest id; columns as before.

    Of several rows of that id, the smallest text stays.
    """
    found = join(docs, text).select("doc_id", "component_id")
    gone = saved(found.where("doc_id != component_id").select("doc_id").distinct(), "jaccard_gone")
    kept = docs.join(gone, "doc_id", "left_anti")
    again = saved(kept.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "jaccard_again")
    if again.isEmpty():
        return kept.select(docs.columns)
    least = kept.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min_by(F.struct(*[c for c in docs.columns]), F.coalesce(text, F.lit(""))).alias("row")
    )
    alone = kept.join(again, "doc_id", "left_anti").select(docs.columns)
    return alone.unionByName(least.select("row.*").select(docs.columns))
