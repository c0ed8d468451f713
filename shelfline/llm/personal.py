"""Personal data: fixed patterns, and contextual extraction bootstrapped from their hits.

Hits of the fixed patterns are seeds. A lexical pattern is the two words before an entity
together with the entity's shape (digits 9, letters a, runs folded). Patterns and instances
form a bipartite graph whose edges are counted over the whole corpus. In each round the
confidence of a pattern is the weighted share of its occurrences that belong to instances
believed so far, and an instance is believed as much as its best accepted pattern. Accepted
patterns (confidence and number of distinct believed instances above thresholds) mark their
other occurrences as identifiers of kind "context".

Built-in functions only. Occurrences carry no text. Edges are summed map-side before they
are shuffled, so a context with a third of all occurrences arrives as few rows; joins on
contexts and instances are left to Spark's skew handling.

Defined cases: a null or empty text has no spans; spans are in code points, end exclusive;
repeated documents are separate rows; result columns replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import saved, without
from shelfline.llm.spans import SPAN, count_of, hits, listed, ordered, replaced, spans

# The patterns, in the order of their ranks. Possessive repeats and the look
# behind change no hit; they keep the search linear and off the stack on hostile texts.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

#: Strings that may be identifiers: six or more characters, a digit among them.
CANDIDATE = r"(?<![A-Za-z0-9])(?=[A-Za-z@._:/-]{0,62}[0-9])[A-Za-z0-9][A-Za-z0-9@._:/-]{4,62}[A-Za-z0-9](?![A-Za-z0-9])"
ROUNDS = 3
CONFIDENCE = 0.8
SUPPORT = 3
#: Belief passed on to an instance by its best pattern.
DAMPING = 0.9

OCCURRENCES = "array<struct<start:int,end:int,gap:string,hit:string,seed:boolean>>"


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _digits(h: Column) -> Column:
    return F.regexp_replace(h["hit"], "[^0-9]", "")


def base_hits(text: Column) -> dict[str, Column]:
    """Hits of each fixed pattern that pass their test."""
    numbers = text.rlike("[0-9]")

    def small(h: Column) -> Column:
        part = lambda p: F.ltrim(p, F.lit("0"))  # noqa: E731  of any length
        return F.forall(
            F.split(h["hit"], r"\."),
            lambda p: (F.length(part(p)) <= 3) & (F.concat(F.lit("0"), F.left(part(p), F.lit(3))).cast("int") <= 255),
        )

    card = lambda h: F.length(_digits(h)).between(14, 19)
    return {
        "email": hits(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(hits(text, IP, numbers), small),
        "card": F.filter(F.filter(hits(text, CARD, numbers), card), lambda h: luhn(_digits(h))),
        "phone": F.filter(hits(text, PHONE, F.contains(text, F.lit("+"))), lambda h: F.length(_digits(h)).between(10, 15)),
    }


def _occurrences(found: Column, seed: bool) -> Column:
    return F.transform(
        found,
        lambda h: F.struct(
            h["start"].alias("start"),
            (h["start"] + F.length(h["hit"])).alias("end"),
            h["gap"].alias("gap"),
            h["hit"].alias("hit"),
            F.lit(seed).alias("seed"),
        ),
    ).cast(OCCURRENCES)


def with_base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``occurrences`` (seeds, and candidates apart from them)."""
    docs = without(docs, ["base_spans", "occurrences", "pii_spans", "row"])
    whole = F.coalesce(F.col(text), F.lit(""))
    found = docs.select("*", *[h.alias(f"_{kind}") for kind, h in base_hits(whole).items()])
    seeds = F.concat(*[_occurrences(F.col(f"_{kind}"), True) for kind in KINDS])
    others = F.filter(
        _occurrences(hits(whole, CANDIDATE, whole.rlike("[0-9]")), False),
        lambda o: ~F.exists("_seeds", lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"])),
    )
    return (
        found.withColumn("_seeds", seeds)
        .withColumn("base_spans", ordered(*[spans(F.col(f"_{kind}"), kind, k) for k, kind in enumerate(KINDS)]))
        .withColumn("occurrences", F.concat("_seeds", others))
        .drop("_seeds", *[f"_{kind}" for kind in KINDS])
    )


def context(gap: Column) -> Column:
    """The two words before an entity, letters only and in lower case; null without two."""
    words = F.regexp_extract(gap, r"(\S+)\s+(\S+)\s+\W*$", 0)
    return F.when(words != "", F.trim(F.regexp_replace(F.lower(words), r"[^\p{L}]+", " ")))


def shape(hit: Column) -> Column:
    folded = F.regexp_replace(F.regexp_replace(hit, "[0-9]+", "9"), "[A-Za-z]+", "a")
    return F.regexp_replace(folded, r"(a[._%+-])+a?@", "a@")


def induced_patterns(
    found: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT
) -> DataFrame:
    """Accepted patterns of occurrences (``pattern``, ``hit``, ``seed``): one row each."""
    edges = saved(
        found.groupBy("pattern", "hit").agg(F.count("*").alias("n"), F.max("seed").alias("seed")), "pii_edges"
    )
    belief = None
    for _ in range(rounds):
        known = edges.join(belief, "hit", "left") if belief is not None else edges.withColumn("belief", F.lit(0.0))
        score = F.when(F.col("seed"), 1.0).otherwise(F.coalesce("belief", F.lit(0.0)))
        accepted = saved(
            known.withColumn("score", score)
            .groupBy("pattern")
            .agg(
                (F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("confidence"),
                F.count_if(F.col("score") >= 0.5).alias("support"),
            )
            .where((F.col("confidence") >= confidence) & (F.col("support") >= support)),
            "pii_patterns",
        )
        belief = (
            edges.where(~F.col("seed"))
            .join(accepted, "pattern")
            .groupBy("hit")
            .agg((F.max("confidence") * DAMPING).alias("belief"))
        )
    return accepted


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) with ``base_spans`` and ``pii_spans``."""
    names = keep if keep is not None else docs.columns
    scanned = with_base_spans(docs, text).select(
        *names, "base_spans", "occurrences", F.monotonically_increasing_id().alias("row")
    )
    scanned = saved(scanned, "pii_scan")  # row ids are fixed once written
    each = scanned.where(F.size("occurrences") > 0).select("row", F.explode("occurrences").alias("o"))
    found = each.select(
        "row",
        "o.start",
        "o.end",
        "o.seed",
        F.lower("o.hit").alias("hit"),
        F.concat_ws(" ", context(F.col("o.gap")), shape(F.col("o.hit"))).alias("pattern"),
        context(F.col("o.gap")).alias("context"),
    ).where(F.col("context").contains(" "))
    accepted = induced_patterns(found.select("pattern", "hit", "seed"))
    span = F.struct("start", F.lit(len(KINDS)).alias("rank"), "end", F.lit("context").alias("kind"))
    extra = (
        found.where(~F.col("seed"))
        .join(accepted.select("pattern"), "pattern", "left_semi")
        .groupBy("row")
        .agg(F.collect_list(span).cast(SPAN).alias("extra"))
    )
    joined = scanned.drop("occurrences").join(extra, "row", "left")
    more = F.coalesce("extra", F.array().cast(SPAN))
    return joined.withColumn("pii_spans", ordered(F.col("base_spans"), more)).drop("extra", "row")


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind; columns as before."""
    found = find(docs, text)
    label = lambda s: F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
    return found.withColumn(text, replaced(F.col(text), F.col("pii_spans"), label)).select(docs.columns)


def report(docs: DataFrame) -> DataFrame:
    found = find(docs.select("doc_id", "text"), keep=["doc_id"])
    base = F.col("base_spans")
    return found.select(
        "doc_id",
        *[count_of(base, kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.encode(listed(base), "UTF-8"), 256).alias("base_sha256"),
        listed(F.col("pii_spans")).alias("spans"),
    )
