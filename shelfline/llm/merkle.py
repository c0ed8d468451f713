"""Merkle manifest of a table: a hash tree for each group of rows, and one over the groups.

A leaf is the SHA-256 of a row's fields. Within a group the leaves stand in order of their
id; while several nodes remain, every ``ARITY`` consecutive ones become one. What remains
is the group's root ("subroot"); the subroots, in order of their groups, make the root.

Every level is a self-join: the slot-zero node of each run states the indices of its
siblings (its own plus a slot offset), an equi-join on group and index finds them, and the
slot-zero rows emit the parents. A level is written before the next is built, so a lost
executor costs one level, and each has an eighth of the rows of the one below. Siblings
are read back from those levels from the top down, so that the path of a leaf costs one
join of the leaves, whatever the height.

Positions come from a range sort and the row counts of its partitions; no group is ever in
one task. Digests are handled as lower-case hex text.

Defined cases: null fields are ``-``; the null group comes first; an empty text is ``0:``;
texts of any length are hashed whole; rows of equal id stand in order of their leaf, so
repeated rows are leaves of their own; null ids come first and are never tampered with; a
lone leaf is its own subroot and has no siblings; an empty table has an empty manifest;
columns other than the fields take no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import saved

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Row numbers of ``monotonically_increasing_id`` within a partition.
IN_PARTITION = (1 << 33) - 1


def _hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(changed: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS) -> Column:
    """Digest of a row, with other values for the fields in ``changed``."""
    return _hash(F.concat(*[field((changed or {}).get(c, F.col(f"`{c}`"))) for c in fields]))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (with a non-null ``group``) with ``pos``, their place in the group, and its size ``n``."""
    keys = [F.col("group"), *[F.col(c).asc_nulls_first() for c in order]]
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit(IN_PARTITION))
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = saved(ranged.select("*", F.spark_partition_id().alias("part"), nth.alias("nth")), "merkle_sorted")
    # At most one row for each partition and one more for each group.
    parts = ranged.groupBy("group", "part").agg(F.min("nth").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy("group")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "group",
        "part",
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("n"),
    )
    found = ranged.join(parts, ["group", "part"]).withColumn("pos", F.col("nth") + F.col("shift"))
    return saved(found.drop("part", "nth", "shift"), "merkle_placed")


def runs_of(nodes: DataFrame) -> DataFrame:
    """``group``, ``run``, ``n``, ``kids`` (digests from left to right) and ``parent`` of every run.

    ``nodes``: ``group``, ``pos``, ``n`` nodes in the group at this level, ``digest``.
    """
    last = F.least(F.lit(ARITY - 1), F.col("n") - 1 - F.col("pos")).cast("int")
    wanted = (
        nodes.where(F.col("pos") % ARITY == 0)
        .select("group", "n", "pos", F.explode(F.sequence(F.lit(0), last)).alias("offset"))
        .select("group", "n", (F.col("pos") / ARITY).cast("long").alias("run"), "offset", (F.col("pos") + F.col("offset")).alias("sibling"))
    )
    siblings = nodes.select("group", F.col("pos").alias("sibling"), "digest")
    runs = wanted.join(siblings, ["group", "sibling"]).groupBy("group", "run", "n")
    kids = runs.agg(F.sort_array(F.collect_list(F.struct("offset", "digest"))).alias("kids"))
    kids = kids.withColumn("kids", F.transform("kids", lambda k: k["digest"]))
    return kids.withColumn("parent", _hash(F.array_join("kids", "")))


def grown(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level, and of each group the ``level`` and ``digest`` of its root."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    runs: list[DataFrame] = []
    tops = nodes.where("n = 1").select("group", F.lit(0).alias("level"), "digest")
    while most > 1:
        found = saved(runs_of(nodes.where("n > 1")), "merkle_runs")
        runs.append(found)
        size = F.ceil(F.col("n") / ARITY).cast("long").alias("n")
        nodes = found.select("group", F.col("run").alias("pos"), size, F.col("parent").alias("digest"))
        tops = tops.unionByName(nodes.where("n = 1").select("group", F.lit(len(runs)).alias("level"), "digest"))
        most = -(-most // ARITY)
    return runs, tops


def _step(slot: Column) -> Column:
    """What stands left and right of a node in its run, as one-element path."""
    left = F.array_join(F.slice("kids", F.lit(1), slot), "")
    right = F.array_join(F.slice("kids", slot + 2, F.lit(ARITY)), "")
    return F.array(F.struct(left.alias("left"), right.alias("right")))


def stems(runs: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Of every run of leaves: ``group``, ``run``, ``kids`` (null for a lone leaf) and its ``path`` up to the root.

    ``tops``: ``group``, ``level``, the ``path`` above the group's root, and further columns to hand down.
    """
    handed = [c for c in tops.columns if c not in ("level", "path")]
    at = lambda level: tops.where(F.col("level") == level).select(*handed, F.lit(0).cast("long").alias("run"), "path")
    above = at(len(runs))
    for level in reversed(range(1, len(runs))):
        joined = runs[level].select("group", "run", "kids").join(above, ["group", "run"])
        spread = joined.select("*", F.explode(F.sequence(F.lit(0), F.size("kids") - 1)).alias("slot"))
        node = (F.col("run") * ARITY + F.col("slot")).alias("run")
        above = spread.select(*handed, node, F.concat(_step(F.col("slot")), "path").alias("path")).unionByName(at(level))
    if not runs:
        return above.withColumn("kids", F.lit(None).cast("array<string>"))
    whole = runs[0].select("group", "run", "kids").join(above, ["group", "run"])
    return whole.unionByName(at(0).withColumn("kids", F.lit(None).cast("array<string>")))


def path_of(leaves: DataFrame, below: DataFrame) -> DataFrame:
    """``leaves`` (``group``, ``pos``) with the columns of their stem and their own ``path``."""
    run = (F.col("pos") / ARITY).cast("long")
    slot = (F.col("pos") % ARITY).cast("int")
    joined = leaves.withColumn("run", run).join(below, ["group", "run"])
    own = F.when(F.col("kids").isNull(), F.col("path")).otherwise(F.concat(_step(slot), "path"))
    return joined.withColumn("path", own).drop("run", "kids")


def proof(path: Column) -> Column:
    return _hash(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def folded(path: Column, start: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, start, lambda so_far, p: _hash(F.concat(p["left"], so_far, p["right"])))


def manifest(docs: DataFrame, group: str = "lang", key: str = "doc_id", tampered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """``key``, ``group_value``, ``leaf``, ``subroot``, ``root``, ``path``, ``changed_leaf`` of every row.

    ``changed_leaf`` is the leaf with the values in ``tampered`` for the rows ``where`` holds,
    else the leaf itself.
    """
    changed = F.when(F.coalesce(where, F.lit(False)), leaf(tampered)) if where is not None else F.lit(None).cast("string")
    # Text that starts with a sign is above the empty text, so the null group comes first.
    name = F.when(F.col(f"`{group}`").isNull(), "").otherwise(F.concat(F.lit("+"), F.col(f"`{group}`")))
    leaves = saved(docs.select(F.col(f"`{key}`").alias("key"), name.alias("group"), leaf().alias("digest"), changed.alias("changed")), "merkle_leaves")
    leaves = placed(leaves, "key", "digest")
    runs, tops = grown(leaves.select("group", "pos", "n", "digest"))
    groups = tops.select(F.lit("").alias("group"), F.col("group").alias("member"), "level", "digest")
    groups = placed(groups, "member")
    outer_runs, outer_top = grown(groups.select("group", "pos", "n", "digest"))
    empty = F.array().cast("array<struct<left:string,right:string>>")
    outer = stems(outer_runs, outer_top.select("group", "level", empty.alias("path"), F.col("digest").alias("root")))
    tops = path_of(groups.drop("n"), outer).select(
        F.col("member").alias("group"), "level", "path", F.col("digest").alias("subroot"), "root"
    )
    tops = saved(tops, "merkle_tops")
    found = path_of(leaves.drop("n"), stems(runs, tops))
    return found.select(
        F.col("key").alias(key),
        F.when(F.col("group") != "", F.substring("group", 2, 1 << 30)).alias("group_value"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "path",
        F.coalesce("changed", "digest").alias("changed_leaf"),
    )


def report(docs: DataFrame) -> DataFrame:
    """Manifest and proofs; where 3 divides the id's CRC-32, the text is folded in lower case."""
    lower = F.translate("text", UPPER, UPPER.lower())
    where = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = manifest(docs, tampered={"text": lower}, where=where)
    found = found.withColumn("folded_root", folded(F.col("path"), F.col("changed_leaf")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
