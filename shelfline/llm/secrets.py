"""Secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings.

All of it is built-in functions, and no row leaves its task. Candidates are unbroken runs of
20 or more characters of ``[A-Za-z0-9+/_=-]``. Each belongs to a character class (hex or
base64) with its own alphabet and threshold. A window of 20 characters slides over it; the
counts per character and the sum of c*log2(c) are updated by the character that enters and
the one that leaves. From the first to the last window at or above the threshold is one
span, unless the candidate is on the allow-list or overlaps a span of a fixed pattern.

A candidate is cut into its characters once, and a step touches a few packed counts: time
grows with the length of a candidate, also of one that fills a text. The sum is kept in
whole units of 2**-32, so it does not drift.

Defined cases: a null or empty text has no spans; repeated rows are scanned like others;
spans are in code points, end exclusive; other columns pass through and result columns
replace input columns of the same name.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import without
from shelfline.llm.spans import SPAN, count_of, hits, listed, ordered, spans

# The patterns, in the order of their ranks.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGNED = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}+"  # the long ones among the maximal runs
LEAST = {"assign": 8, "access": 16, "hex": 32}

WINDOW = 20
CANDIDATE = rf"(?:\G|(?<![A-Za-z0-9+/_=-]))[A-Za-z0-9+/_=-]{{{WINDOW},}}+"
#: Alphabet and least bits a character, by class.
CLASSES = {
    "hex": ("0123456789abcdef", 3.0),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.8),
}
#: Candidates that are no secrets: UUIDs, published sample keys, numbers.
ALLOWED = r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|EXAMPLE|^[0-9]+$"
#: Words and paths without digits are none either, unless capitals stand as in no word.
WORDS = r"^[A-Za-z/_=-]+$"
NO_WORD = r"[A-Z][a-z][A-Z]"

#: Counts to a long, and bits of a count.
PACKED, BITS = 12, 5
#: Units of the sum of c*log2(c).
UNIT = 2**32


def _rise(count: Column) -> Column:
    """By how much c*log2(c) grows from a count to the next, in units; null where there is no count."""
    weights = [round(c * log2(c) * UNIT) if c else 0 for c in range(WINDOW + 1)]
    return F.get(F.array(*[F.lit(b - a).cast("long") for a, b in zip(weights, weights[1:])]), count)


def _places(candidate: Column, alphabet: str) -> Column:
    """For every character, the long and the bit where its count begins."""

    def place(char: Column) -> Column:
        k = F.instr(F.lit(alphabet), char) - 1
        return F.struct((k / PACKED).cast("int").alias("word"), ((k % PACKED) * BITS).cast("int").alias("bit"))

    return F.transform(F.split(candidate, ""), place)


def dense_windows(places: Column, alphabet: str, least: float) -> Column:
    """Start of the first and end of the last window of at least ``least`` bits, or -1 twice."""
    one = lambda p: F.call_function("shiftleft", F.lit(1).cast("long"), p["bit"])

    def count(counts: Column, p: Column) -> Column:
        shifted = F.call_function("shiftright", F.get(counts, p["word"]), p["bit"])
        return shifted.bitwiseAND(F.lit(2**BITS - 1).cast("long")).cast("int")

    most = round((log2(WINDOW) - least) * WINDOW * UNIT)
    zero = F.lit(0).cast("long")

    def step(state: Column, move: Column) -> Column:
        gone, came, counts = move["gone"], move["came"], state["counts"]
        grown = _rise(count(counts, came)) - F.coalesce(_rise(count(counts, gone) - 1), zero)
        total = F.when(gone == came, state["total"]).otherwise(state["total"] + grown)
        after = F.transform(
            counts,
            lambda c, k: c
            + F.when(k == came["word"], one(came)).otherwise(zero)
            - F.when(k == gone["word"], one(gone)).otherwise(zero),
        )
        end = state["end"] + 1
        dense = (end >= WINDOW) & (total <= most)
        return F.struct(
            after.alias("counts"),
            total.alias("total"),
            end.alias("end"),
            F.when((state["first"] < 0) & dense, end - WINDOW).otherwise(state["first"]).alias("first"),
            F.when(dense, end).otherwise(state["last"]).alias("last"),
        )

    nothing = F.struct(F.lit(-1).alias("word"), F.lit(0).alias("bit"))
    moves = F.arrays_zip(
        F.concat(F.array_repeat(nothing, WINDOW), F.slice(places, F.lit(1), F.size(places) - WINDOW)).alias("gone"),
        places.alias("came"),
    )
    start = F.struct(
        F.array_repeat(zero, -(-len(alphabet) // PACKED)).alias("counts"),
        zero.alias("total"),
        F.lit(0).alias("end"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
    )
    return F.aggregate(moves, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def entropy_spans(text: Column, base: Column, rank: int) -> Column:
    """Spans of candidates with dense windows, apart from allowed ones and from ``base``."""

    def allowed(h: Column) -> Column:
        return h["hit"].rlike(ALLOWED) | (h["hit"].rlike(WORDS) & ~h["hit"].rlike(NO_WORD))

    def coded(h: Column) -> Column:
        is_hex = h["hit"].rlike("^[0-9a-fA-F]+$")
        places = F.when(is_hex, _places(F.lower(h["hit"]), CLASSES["hex"][0])).otherwise(
            _places(h["hit"], CLASSES["base64"][0])
        )
        return F.struct(h["start"].alias("start"), is_hex.alias("is_hex"), places.alias("places"))

    def windows(c: Column) -> Column:
        return F.when(c["is_hex"], dense_windows(c["places"], *CLASSES["hex"])).otherwise(
            dense_windows(c["places"], *CLASSES["base64"])
        )

    found = F.transform(F.filter(hits(text, CANDIDATE), lambda h: ~allowed(h)), coded)
    placed = F.transform(found, lambda c: F.struct(c["start"].alias("start"), windows(c).alias("w")))
    dense = F.filter(placed, lambda p: p["w"]["first"] >= 0)
    out = F.transform(
        dense,
        lambda p: F.struct(
            (p["start"] + p["w"]["first"]).alias("start"),
            F.lit(rank).alias("rank"),
            (p["start"] + p["w"]["last"]).alias("end"),
            F.lit("entropy").alias("kind"),
        ),
    ).cast(SPAN)
    return F.filter(out, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def with_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` (fixed patterns) and ``secret_spans`` (these and the entropy spans)."""
    docs = without(docs, ["base_spans", "secret_spans"])
    whole = F.coalesce(F.col(text), F.lit(""))
    value = lambda h: F.regexp_extract(h["hit"], ASSIGNED, 1)
    assign = F.filter(hits(whole, ASSIGN), lambda h: F.length(value(h)) >= LEAST["assign"])
    access = F.filter(
        hits(whole, ACCESS, F.contains(whole, F.lit("AKIA"))), lambda h: F.length(h["hit"]) >= LEAST["access"]
    )
    hexes = hits(whole, HEX)
    base = ordered(spans(assign, "assign", 0), spans(access, "access", 1), spans(hexes, "hex", 2))
    out = docs.withColumn("base_spans", base)
    return out.withColumn(
        "secret_spans", ordered(F.col("base_spans"), entropy_spans(whole, F.col("base_spans"), len(LEAST)))
    )


def report(docs: DataFrame) -> DataFrame:
    found = with_secrets(docs.select("doc_id", "text"))
    base = F.col("base_spans")
    return found.select(
        "doc_id",
        *[count_of(base, kind).alias(f"n_{kind}") for kind in LEAST],
        F.sha2(F.encode(listed(base), "UTF-8"), 256).alias("base_sha256"),
        listed(F.col("secret_spans")).alias("spans"),
    )
