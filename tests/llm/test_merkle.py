"""The manifest against a plain tree built in memory."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from shelfline.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    """Root, and for every leaf the siblings (left, right) from the bottom up."""
    paths, places = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for k, at in enumerate(places):
            base = at - at % 8
            paths[k].append(("".join(digests[base:at]), "".join(digests[at + 1 : base + 8])))
        digests = [H("".join(digests[i : i + 8])) for i in range(0, len(digests), 8)]
        places = [at // 8 for at in places]
    return digests[0], paths


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = []
    for name in names:
        members = sorted(groups[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        built.append((members, *tree([leaf(r, r["text"]) for r in members])))
    root, above = tree([b[1] for b in built])
    out = []
    for (members, subroot, paths), up in zip(built, above):
        for r, path in zip(members, paths):
            path = path + up
            i, text = r["doc_id"], r["text"]
            if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 and text is not None:
                text = text.translate(LOWER)
            folded = leaf(r, text)
            for a, b in path:
                folded = H(a + folded + b)
            proof = H("".join(a + b for a, b in path))
            out.append((i, leaf(r, r["text"]), subroot, root, proof, folded, folded == root))
    return out


def table(spark, rows, extra=False):
    df = spark.createDataFrame([tuple(r[f.split()[0]] for f in SCHEMA.split(", ")) for r in rows], SCHEMA)
    if extra:
        df = df.withColumns({c: F.lit("x") for c in ("group", "pos", "n", "part", "digest", "key", "path", "level")})
    return df


def row(doc_id, text="Ab", lang="en", source="web", n_chars=2):
    return dict(doc_id=doc_id, text=text, lang=lang, source=source, n_chars=n_chars)


def got(df):
    return sorted(map(tuple, merkle.report(df).collect()), key=repr)


CASES = {
    "one": [row(3)],
    "two groups of one": [row(3), row(4, lang=None)],
    "run of one at the end": [row(i, text=f"Text {i}") for i in range(9)],
    "several levels": [row(i, text=f"Text {i}") for i in range(70)] + [row(100 + i, lang="de") for i in range(8)],
    "many groups": [row(i, lang=f"l{i % 11}") for i in range(40)],
    "nulls and empties": [
        row(None, None, None, None, None),
        row(None, "", "", "", 0),
        row(1, None, "en"),
        row(2, "", "en", None, None),
        row(-5, "Ünï CÖDE 木", "é"),
        row(6, "-", "-", "-"),
    ],
    "repeated rows": [row(1), row(1), row(1, text="other"), row(2), row(2)],
    "long text": [row(9, "Word " * 200_000), row(12, "Word " * 200_000 + "x")],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_equals_a_tree_in_memory(spark, case):
    assert got(table(spark, CASES[case])) == sorted(expected(CASES[case]), key=repr)


def test_clashing_columns_are_ignored(spark):
    rows = CASES["several levels"]
    assert got(table(spark, rows, extra=True)) == sorted(expected(rows), key=repr)


def test_an_empty_table_has_an_empty_manifest(spark):
    assert merkle.report(table(spark, [])).collect() == []


def test_any_change_of_a_field_is_found(spark):
    rows = [row(i, text=f"t {i}") for i in range(20)]
    changed = table(spark, rows)
    found = merkle.manifest(changed, tampered={"source": F.lit("elsewhere")}, where=F.col("doc_id") == 7)
    found = found.withColumn("folded", merkle.folded(F.col("path"), F.col("changed_leaf")))
    assert {r.doc_id for r in found.where("folded != root").collect()} == {7}


def test_levels_are_equi_joins(spark, plan_of):
    plan = plan_of(merkle.runs_of(spark.range(20).selectExpr("'' as group", "id as pos", "20L as n", "string(id) as digest")))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
