"""The join against all pairs, with keys that many sets share."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import jaccard

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = (text or "").translate(LOWER).encode().split()
    size = min(5, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()


def expected(rows):
    """Number of shingles and component of each row, by counting common shingles of all pairs."""
    sets = [shingles(t) for _, t in rows]
    places = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            places[x].append(k)
    root = list(range(len(rows)))

    def of(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k, s in enumerate(sets):
        for other, n in Counter(o for x in s for o in places[x] if o < k).items():
            if 100 * n >= 80 * (len(s) + len(sets[other]) - n):
                root[of(k)] = of(other)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[of(k)] = min(i, least.get(of(k), i))
    return sorted(((i, len(s), least.get(of(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def got(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    extra = df.withColumns({c: F.lit("x") for c in ("set_id", "key", "n_shingles", "bits", "root", "n", "payload")})
    return sorted(map(tuple, jaccard.join(extra.repartition(3)).collect()), key=repr)


def told(rng, n, kind="w"):
    return [f"{kind}{k}" for k in rng.integers(0, 10**6, n)]


def near_but_not_alike(n, seed=1):
    """Texts that share 70 of 100 words, so that no two of different families are alike."""
    rng = np.random.default_rng(seed)
    shared = told(rng, 70)
    rows = []
    for family in range(n):
        own = told(rng, 30)
        for member in range(int(rng.integers(1, 4))):
            words = shared + own
            words[int(rng.integers(75, 100))] = f"m{member}"
            rows.append((len(rows), " ".join(words)))
    return rows


CASES = {
    "one passage in all": near_but_not_alike(150),
    "chains": [(i, " ".join(f"c{k}" for k in range(3 * i, 3 * i + 60))) for i in range(120)],
    "copies": [(i, "the very same text of more than five words") for i in range(60)] + [(100 + i, f"a single {i} text of its own here") for i in range(9)],
    "edges": [(1, None), (2, ""), (3, " \n\t"), (4, "A b"), (5, "a B"), (6, "a b c"), (7, "a b c d e"), (7, "a b c d E"), (None, "a b c d e"), (None, "alone is null"), (9, "x " * 40_000 + "y"), (10, "x " * 40_000 + "z")],
    "long": [(i, " ".join(told(np.random.default_rng(4), 30_000)) + f" tail {i}") for i in range(4)],
    "one": [(3, "five words and one more")],
    "none": [],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_equals_all_pairs(spark, case):
    assert got(spark, CASES[case]) == expected(CASES[case])


def test_hot_keys_are_dealt_in_blocks(spark, monkeypatch):
    """Blocks of a few sets, and no shingle put last, so that all meet at the shared keys."""
    monkeypatch.setattr(jaccard, "KEY_HASHES", 1_000)
    monkeypatch.setattr(jaccard, "frequent", lambda texts: jaccard.NONE)
    rows = near_but_not_alike(120, 2)
    dealt = []
    opened = jaccard._open
    monkeypatch.setattr(jaccard, "_open", lambda *a: dealt.append(opened(*a)) or dealt[0])
    seen = []
    asked = jaccard._in_question
    monkeypatch.setattr(jaccard, "_in_question", lambda d, *a: seen.append(d.agg(F.max("y")).first()[0]) or asked(d, *a))
    assert got(spark, rows) == expected(rows)
    assert seen[0] and seen[0] >= 5


def test_links_do_not_grow_with_pairs(spark, monkeypatch):
    """One key, many families of near copies: fewer links than sets."""
    links = []
    search = jaccard._search
    monkeypatch.setattr(jaccard, "_search", lambda *a: links.append(search(*a).persist()) or links[0])
    rows = near_but_not_alike(200, 3)
    assert got(spark, rows) == expected(rows)
    assert not links or links[0].count() < len(rows)


def test_any_order_of_shingles_keeps_shared_ones():
    rng = np.random.default_rng(8)
    for _ in range(200):
        a = np.unique(rng.integers(0, 400, 60).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.06], rng.integers(0, 400, 3).astype(np.uint64)]))
        last = np.unique(rng.integers(0, 400, 150).astype(np.uint64))
        if jaccard.alike(a, b):
            assert np.intersect1d(jaccard.prefix(a, last=last), jaccard.prefix(b, last=last)).size


def test_shared_passages_are_put_last(spark):
    rows = near_but_not_alike(60)
    last = jaccard.frequent(spark.createDataFrame(rows * 4, "doc_id long, text string").select("text"))
    assert len(last) >= 60 and (np.diff(last.astype(float)) > 0).all()


def test_documents_of_the_fixture(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert sorted(map(tuple, jaccard.join(df).collect()), key=repr) == expected(rows)
