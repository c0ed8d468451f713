"""One boosted-tree model for all series, grown a tree at a time by Spark ML.

Trees see at most :data:`BINS` bins of each feature, so training rows that fall into
the same bin of every feature are one case: their count is its weight and their mean
label its label. For squared loss that changes neither a split nor a leaf, and demand
that is mostly zero shrinks to a fraction of its rows. One aggregation with map-side
combine makes the cases; every tree then scans them instead of the days.

Boosting keeps its state: the running prediction of each case, written to the shared
folder every few rounds. A round fits one ``DecisionTreeRegressor`` to what is left,
scores the holdout, and the search ends ``patience`` rounds after the best one. No tree
is ever grown twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.schemas import FEATURE_COLUMNS, SERIES
from shelfline.session import new_dir

# Squared loss, shrinkage 0.05, at most 500 rounds, of which the last
# 20 without a smaller absolute error on the holdout end the search; depth 5 gives
# the 32 leaves closest to a 31-leaf tree.
GBT_DEFAULTS: dict[str, Any] = {
    "lossType": "squared",
    "stepSize": 0.05,
    "maxIter": 500,
    "maxDepth": 5,
    "seed": 7,
}
PATIENCE = 20
# Accuracy of quantiles: a rank may be off by the number of rows over this.
ACCURACY = 1_000
# Bins of a feature, and rounds between two written states.
BINS = 32
WRITE_EVERY = 10


def best_round(errors: Sequence[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """Number of rounds to keep, and whether ``patience`` rounds without a gain follow them."""
    best = 0
    for at, error in enumerate(errors):
        if error < errors[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def bin_edges(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Lower edges of the bins of every feature but the first bin, in two passes.

    A value with its share of a bin or more has a bin of its own; the other values are
    cut at their quantiles. Without that, a feature that is mostly zero would have few
    bins for all the rest.
    """
    grid = [k / bins for k in range(1, bins)]
    value = {c: F.col(c).cast("double") for c in features}
    first = rows.agg(
        *[F.percentile_approx(v, F.lit(grid), ACCURACY).alias(c) for c, v in value.items()],
        *[F.min(v).alias(f"{c}__min") for c, v in value.items()],
    ).first()
    often = {}
    for c in features:
        found = first[c] or []
        often[c] = sorted({v for v in found if found.count(v) > 1})
    others = {c: bins - 1 - len(often[c]) for c in features}
    light = rows.agg(
        *[
            F.percentile_approx(
                F.when(~value[c].isin(often[c]) if often[c] else F.lit(True), value[c]),
                F.lit([k / max(1, others[c]) for k in range(max(1, others[c]))]),
                ACCURACY,
            ).alias(c)
            for c in features
        ]
    ).first()
    edges = []
    for c in features:
        cuts = {*often[c], *((light[c] or []) if others[c] > 0 else [])}
        edges.append(sorted(v for v in cuts if v > first[f"{c}__min"]))
    return edges


@dataclass(frozen=True)
class PooledModel:
    """Bin edges and the trees that count, with the weight of each."""

    features: list[str]
    edges: list[list[float]]
    trees: list[DecisionTreeRegressionModel]
    weights: list[float]
    #: Mean absolute error on the holdout after every round grown, kept or not.
    errors: list[float] = field(default_factory=list)

    def binned(self, rows: DataFrame) -> DataFrame:
        """``rows`` with one column for the bin of each feature."""
        infinite = float("inf")
        # A feature without edges has one value; an edge above all values keeps its bin whole.
        splits = [[-infinite, *(e or [1e300]), infinite] for e in self.edges]
        cast = rows.withColumns({f"_x{k}": F.col(c).cast("double") for k, c in enumerate(self.features)})
        numbers = range(len(self.features))
        cut = Bucketizer(
            splitsArray=splits,
            inputCols=[f"_x{k}" for k in numbers],
            outputCols=self.bin_columns,
            handleInvalid="keep",
        )
        return cut.transform(cast).drop(*[f"_x{k}" for k in numbers])

    @property
    def bin_columns(self) -> list[str]:
        return [f"_b{k}" for k in range(len(self.features))]

    def assembled(self, binned: DataFrame) -> DataFrame:
        vectors = VectorAssembler(inputCols=self.bin_columns, outputCol="_bins").transform(binned)
        return vectors.drop(*self.bin_columns)

    @property
    def num_trees(self) -> int:
        return len(self.trees)

    def score(self, rows: DataFrame, output: str = "prediction") -> DataFrame:
        """``rows`` with the model's prediction; long sums are written every few trees."""
        out = self.assembled(self.binned(rows)).withColumn(output, F.lit(0.0))
        for start in range(0, self.num_trees, WRITE_EVERY):
            part = slice(start, start + WRITE_EVERY)
            for tree, weight in zip(self.trees[part], self.weights[part], strict=True):
                out = stepped(out, tree, weight, output)
            if start + WRITE_EVERY < self.num_trees:
                out = written(out, "pooled-score")
        return out.drop("_bins")


def stepped(rows: DataFrame, tree: DecisionTreeRegressionModel, weight: float, running: str) -> DataFrame:
    """Add a tree's weighted prediction to the running one."""
    added = F.col(running) + F.col("_tree") * weight
    return tree.setPredictionCol("_tree").transform(rows).withColumn(running, added).drop("_tree")


def written(rows: DataFrame, name: str) -> DataFrame:
    """A copy in the shared folder: lost executors cost a read, not the rounds before."""
    path = new_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def cases(train: DataFrame, model: PooledModel) -> DataFrame:
    """Training rows of equal bins as one case: ``weight`` rows with mean ``label``."""
    grouped = model.binned(train).groupBy(*model.bin_columns).agg(
        F.count(F.lit(1)).cast("double").alias("weight"), F.avg("label").alias("label")
    )
    return model.assembled(grouped)


def fit_pooled(
    split: DataFrame,
    features: Sequence[str] = FEATURE_COLUMNS,
    params: Mapping[str, Any] | None = None,
    patience: int = PATIENCE,
) -> PooledModel:
    """Fit on all training rows; the holdout's mean absolute error chooses the round.

    ``params`` override :data:`GBT_DEFAULTS`. As in Spark's own boosting, the first tree
    fits the labels and is not shrunk, later ones fit the negative gradient of the
    squared error, twice the residual.
    """
    settings = {**GBT_DEFAULTS, **(params or {})}
    most, rate, loss = settings.pop("maxIter"), settings.pop("stepSize"), settings.pop("lossType")
    if loss != "squared":
        raise ValueError(f"loss {loss!r}: cases are exact for the squared loss only")
    if most < 1:
        raise ValueError("maxIter must be at least 1")
    known = split.dropna(subset=["sales"]).withColumn("label", F.col("sales").cast("double"))
    train, held = known.where("NOT is_val"), known.where("is_val")
    model = PooledModel(list(features), bin_edges(train, features, settings.get("maxBins", BINS)), [], [])
    start = {"running": F.lit(0.0)}
    state = written(cases(train, model).withColumns(start), "pooled-cases")
    scored = written(model.assembled(model.binned(held.select("label", *features))).select("label", "_bins").withColumns(start), "pooled-held")
    left = F.when(F.lit(True), 2.0 * (F.col("label") - F.col("running")))
    trees, weights, errors = [], [], []
    learner = DecisionTreeRegressor(
        featuresCol="_bins", labelCol="_target", weightCol="weight", **{"maxBins": BINS, **settings}
    )
    done: list[DataFrame] = []
    while True:
        # The rule cannot end the search before this round, so errors are not needed before.
        until = min(most, best_round(errors, patience)[0] + patience if errors else patience + 1)
        while len(trees) < until:
            target = left if trees else F.col("label")
            tree = learner.fit(state.withColumn("_target", target).select("_bins", "_target", "weight"))
            # The fit has made this state; the one before is no longer read.
            while done:
                done.pop().unpersist()
            done.append(state)
            trees.append(tree)
            weights.append(rate if len(trees) > 1 else 1.0)
            state = stepped(state, tree, weights[-1], "running")
            if len(trees) % WRITE_EVERY == 0:
                state = written(state, "pooled-cases")
            # A round reads its state several times; a lost copy is remade from the last
            # written one.
            state = state.persist()
        new = slice(len(errors), len(trees))
        found, scored = _errors(scored, trees[new], weights[new])
        errors += found
        if len(trees) == most or best_round(errors, patience)[1]:
            break
    for kept in [*done, state]:
        kept.unpersist()
    best = best_round(errors, patience)[0]
    return PooledModel(model.features, model.edges, trees[:best], weights[:best], errors)


def _errors(
    scored: DataFrame, trees: Sequence[DecisionTreeRegressionModel], weights: Sequence[float]
) -> tuple[list[float], DataFrame]:
    """Mean absolute error after each of the next ``trees``, in one pass, and the rows after them all."""
    rows, names = scored, []
    for tree, weight in zip(trees, weights, strict=True):
        names.append(f"_after{len(names)}")
        rows = stepped(rows, tree, weight, "running").withColumn(names[-1], F.col("running"))
    rows = written(rows, "pooled-held")
    each = rows.agg(*[F.avg(F.abs(F.col("label") - F.col(n))).alias(n) for n in names]).first()
    return [each[n] for n in names], rows.drop(*names)


def score_pooled(model: PooledModel, split: DataFrame) -> DataFrame:
    """Predictions for the holdout rows, in the backtest layout."""
    held = split.where("is_val").dropna(subset=["sales"])
    return model.score(held).select(
        *SERIES,
        "day_num",
        "cal_date",
        F.col("sales").cast("double").alias("sales"),
        F.col("prediction").alias("predicted"),
        "n_train",
        "train_mean",
    )


def backtest_pooled(
    split: DataFrame,
    features: Sequence[str] = FEATURE_COLUMNS,
    params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Fit and score. The split is written once and read by both.

    The passes over it (edges, cases, holdout) read a table in the shared folder, which
    survives lost executors, where recomputing the feature windows would be the cost.
    """
    extra = ["day_num", "cal_date", "sales", "is_val", "n_train", "train_mean"]
    columns = [*SERIES, *extra, *[c for c in features if c not in extra]]
    saved = written(split.select(*columns), "pooled-split")
    return score_pooled(fit_pooled(saved, features, params), saved)
