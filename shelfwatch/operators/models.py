"""Boosted-tree training, early stop, parameter search and model files, on Spark ML."""

from __future__ import annotations

import math
import random
import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path

# What the model reads.
FEATURES = (
    "store_nbr",
    "onpromotion",
    "day_of_week",
    "month",
    "year",
    "days_to_holiday",
    "lag_7",
    "lag_14",
    "rolling_mean_7",
)
CATEGORY = "family"
# Trees of depth 5 have up to 32 leaves; the step size is the usual default of 0.1.
DEFAULT_PARAMS = {"maxIter": 500, "maxDepth": 5, "stepSize": 0.1, "seed": 42}
PATIENCE = 50


#: Rounds that are fitted before the residuals are written down and the validation rows are asked.
STAGE_ROUNDS = 10
#: Rungs of a search, the part of the trials that goes on after each, and trials fitted at once.
RUNGS, KEEP, WORKERS = 3, 3, 4


def _preparation(features: Sequence[str], category: str | None) -> list:
    stages, inputs = [], list(features)
    if category:
        # Unseen values take the extra last index, which the encoder drops: all zeros.
        stages += [
            StringIndexer(
                inputCol=category, outputCol=f"{category}_index", stringOrderType="alphabetAsc", handleInvalid="keep"
            ),
            OneHotEncoder(inputCol=f"{category}_index", outputCol=f"{category}_flags", dropLast=True),
        ]
        inputs.append(f"{category}_flags")
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def _ensemble(spark: SparkSession, trees: list, weights: list[float]) -> GBTRegressionModel:
    """Fitted trees and their weights as one model of Spark ML."""
    context = spark.sparkContext
    ml = context._jvm.org.apache.spark.ml.regression
    held = context._gateway.new_array(ml.DecisionTreeRegressionModel, len(trees))
    shares = context._gateway.new_array(context._jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        held[i], shares[i] = tree._java_obj, float(weight)
    return GBTRegressionModel(ml.GBTRegressionModel(f"boosted_{uuid.uuid4().hex[:12]}", held, shares))


class StagedTrees:
    """Boosting under squared loss that goes on where it stopped, a stage of rounds at a time.

    Each round fits one tree to what the trees before it leave over. At the end of a stage the
    residuals of both frames are written to the shared folder, so the next stage reads those and
    neither fits nor applies an earlier tree again, and a lost executor costs one stage at most.
    The validation loss after every round of a stage comes from one pass. The frames have the
    columns ``features`` and ``label``.
    """

    def __init__(
        self, train: DataFrame, valid: DataFrame, params: dict, patience: int = PATIENCE, stage_rounds: int = STAGE_ROUNDS
    ):
        self.train, self.valid, self.patience, self.stage_rounds = train, valid, patience, stage_rounds
        self.params = {k: v for k, v in params.items() if k != "maxIter"}
        tree = {k: v for k, v in self.params.items() if k != "stepSize"}
        self.learner = DecisionTreeRegressor(labelCol="__target", predictionCol="__tree", **tree)
        self.trees: list = []
        self.weights: list[float] = []
        self.losses: list[float] = []

    @property
    def stopped(self) -> bool:
        """Whether ``patience`` rounds have gone by without a gain."""
        return len(self.losses) - best_round(self.losses, self.patience) >= self.patience

    def advance(self, rounds: int) -> None:
        """Fit trees until there are ``rounds`` of them, or until the patience is over."""
        while len(self.trees) < rounds and not self.stopped:
            self._stage(min(self.stage_rounds, rounds - len(self.trees)))

    def _stage(self, rounds: int) -> None:
        spark, first = self.train.sparkSession, not self.trees
        trees: list = []
        weights: list[float] = []
        rows = self.train.persist()
        try:
            if first:
                # Spark ML's own boosting, which cannot go on from given trees but is faster for the first ones.
                begun = GBTRegressor(labelCol="label", maxIter=rounds, **self.params).fit(rows)
                trees, weights = list(begun.trees), [float(w) for w in begun.treeWeights]
            for _ in range(rounds - len(trees)):
                # Twice the residual, as the gradient of the squared loss has it.
                before = _ensemble(spark, trees, weights).transform(rows) if trees else rows.withColumn("prediction", F.lit(0.0))
                target = before.withColumn("__target", 2 * (F.col("label") - F.col("prediction")))
                trees.append(self.learner.fit(target.select("features", "__target")))
                weights.append(self.params["stepSize"])
            fitted = _ensemble(spark, trees, weights)
            # What is left of the label is what this stage started from, so its loss is that of all trees.
            self.losses += [float(loss) for loss in fitted.evaluateEachIteration(self.valid, "squared")]
            self.trees += trees
            self.weights += weights
            self.train, self.valid = self._left(fitted, rows), self._left(fitted, self.valid)
        finally:
            rows.unpersist()

    @staticmethod
    def _left(fitted: GBTRegressionModel, rows: DataFrame) -> DataFrame:
        spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "residuals")
        left = fitted.transform(rows).select("features", (F.col("label") - F.col("prediction")).alias("label"))
        left.write.parquet(path)
        return spark.read.schema(left.schema).parquet(path)

    def model(self) -> GBTRegressionModel:
        """The trees up to the best round."""
        kept = max(1, best_round(self.losses, self.patience))
        return _ensemble(self.train.sparkSession, self.trees[:kept], self.weights[:kept])


def _prepared(df: DataFrame, preparation: PipelineModel, label: str) -> DataFrame:
    rows = df.filter(F.col(label).isNotNull())
    return preparation.transform(rows).select("features", F.col(label).cast("double").alias("label"))


def _needed(features: Sequence[str], category: str | None, label: str) -> list[str]:
    return [*features, *([category] if category else []), label]


def fit_stages(
    train: DataFrame,
    valid: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = "sales",
    params: dict | None = None,
    category: str | None = CATEGORY,
    patience: int = PATIENCE,
    stage_rounds: int = STAGE_ROUNDS,
) -> tuple[PipelineModel, list[float]]:
    """(model, validation loss after each round): one fit that ends when its patience is over.

    At most ``stage_rounds - 1`` rounds are fitted beyond the one that ends the patience; the
    model holds the trees up to the best round. The encoder sees the training rows only, and
    rows without a label are left out. Without validation rows there is nothing to stop by:
    that is an error.
    """
    settings = {**DEFAULT_PARAMS, **(params or {})}
    needed = _needed(features, category, label)
    train, valid = (df.select(*needed).filter(F.col(label).isNotNull()) for df in (train, valid))
    if valid.isEmpty():
        raise ValueError("there are no validation rows with a label")
    preparation = Pipeline(stages=_preparation(features, category)).fit(train)
    fit = StagedTrees(*(_prepared(df, preparation, label) for df in (train, valid)), settings, patience, stage_rounds)
    fit.advance(settings["maxIter"])
    return PipelineModel([*preparation.stages, fit.model()]), fit.losses


def train_regressor(
    train: DataFrame,
    valid: DataFrame | None = None,
    features: Sequence[str] = FEATURES,
    label: str = "sales",
    params: dict | None = None,
    category: str | None = CATEGORY,
    patience: int = PATIENCE,
) -> PipelineModel:
    """Fit encoder and boosted trees as one pipeline.

    With ``valid`` the fit goes on in stages until the patience is over, and the model holds the
    trees up to the best round. Without it all rounds are fitted and kept. The encoder sees the
    training rows only.
    """
    if valid is not None:
        return fit_stages(train, valid, features, label, params, category, patience)[0]
    settings = {**DEFAULT_PARAMS, **(params or {})}
    rows = train.select(*_needed(features, category, label)).filter(F.col(label).isNotNull())
    trees = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction", **settings)
    return Pipeline(stages=[*_preparation(features, category), trees]).fit(rows)


def best_round(losses: Sequence[float], patience: int = PATIENCE) -> int:
    """Rounds to keep: the best one before ``patience`` rounds in a row bring no gain."""
    best, best_loss = 0, math.inf
    for i, loss in enumerate(losses, start=1):
        if loss < best_loss:
            best, best_loss = i, loss
        elif i - best >= patience:
            break
    return best


def kept_rounds(losses: DataFrame, fit: str = "trial", turn: str = "round", loss: str = "loss", patience: int = PATIENCE) -> DataFrame:
    """Rows (fit, kept): ``best_round`` of every fit in a table with one row per fit and round.

    A round is a gain when its loss is below all before it; the one kept is the first gain
    that no other follows within ``patience`` rounds. Missing losses are no gain. A window
    holds the rounds of one fit, which ``maxIter`` bounds.
    """
    order = Window.partitionBy(fit).orderBy(turn)
    before = F.min(loss).over(order.rowsBetween(Window.unboundedPreceding, -1))
    gains = losses.select(fit, turn, loss, before.alias("__before")).filter(
        F.col(loss).isNotNull() & (F.col("__before").isNull() | (F.col(loss) < F.col("__before")))
    )
    following = gains.withColumn("__next", F.lead(turn).over(order))
    last = F.col("__next").isNull() | (F.col("__next") > F.col(turn) + patience)
    return following.filter(last).groupBy(fit).agg(F.min(turn).alias("kept"))


def early_stop(model: PipelineModel, valid: DataFrame, patience: int = PATIENCE) -> int:
    """Best number of boosting rounds on the validation rows."""
    prepared = PipelineModel(model.stages[:-1]).transform(valid)
    return best_round(model.stages[-1].evaluateEachIteration(prepared, "squared"), patience)


def trial_params(n_trials: int, seed: int, rounds: tuple[int, int] = (100, 800)) -> list[dict]:
    """Seeded random settings: 8-64 leaves as depth 3-6, step size 0.01-0.3 log-uniform, rounds."""
    draw = random.Random(seed)
    return [
        {
            "maxDepth": round(math.log2(draw.randint(8, 64))),
            "stepSize": math.exp(draw.uniform(math.log(0.01), math.log(0.3))),
            "maxIter": draw.randint(*rounds),
        }
        for _ in range(n_trials)
    ]


def rung_rounds(rounds: int, rungs: int = RUNGS, keep: int = KEEP) -> list[int]:
    """Rounds that a trial has after each rung: the last has all, each one before a ``keep``-th of the next."""
    return [max(1, math.ceil(rounds / keep ** (rungs - 1 - rung))) for rung in range(rungs)]


def survivors(rung: DataFrame, keep: int = KEEP, by: Sequence[str] = ("rung",), loss: str = "val_rmse") -> DataFrame:
    """Add ``goes_on``: the trial is among the best ``keep``-th of its rung, rounded up.

    Equal losses go by trial number, and a missing loss comes last. A rung holds one row for
    each trial of a search.
    """
    whole = Window.partitionBy(*by)
    place = F.row_number().over(whole.orderBy(F.col(loss).asc_nulls_last(), "trial"))
    return rung.withColumn("goes_on", place <= F.ceil(F.count(F.lit(1)).over(whole) / keep))


def search_params(
    train: DataFrame,
    valid: DataFrame,
    n_trials: int = 20,
    seed: int = 42,
    features: Sequence[str] = FEATURES,
    label: str = "sales",
    category: str | None = CATEGORY,
    rounds: tuple[int, int] = (100, 800),
    patience: int = PATIENCE,
    rungs: int = RUNGS,
    keep: int = KEEP,
    workers: int = WORKERS,
    stage_rounds: int = STAGE_ROUNDS,
) -> tuple[dict, DataFrame]:
    """(best settings, one row of trial, rung, maxDepth, stepSize, rounds, maxIter, val_rmse, goes_on for each trial of a rung).

    Successive halving: every trial is fitted for a small part of its rounds, the best
    ``keep``-th of them goes on for ``keep`` times as many, and so on; only those of the last
    rung are fitted in full. A trial that goes on keeps its trees. ``rounds`` are those fitted
    so far and ``maxIter`` those worth keeping. The trials of a rung are submitted to the
    session from ``workers`` threads, so a small job does not leave the cluster idle.

    The features are prepared once, for all trials.
    """
    spark, needed = train.sparkSession, _needed(features, category, label)
    train, valid = (df.select(*needed).filter(F.col(label).isNotNull()) for df in (train, valid))
    preparation = Pipeline(stages=_preparation(features, category)).fit(train)
    frames = []
    for df in (train, valid):
        path, ready = scratch_path(spark, "search-rows"), _prepared(df, preparation, label)
        ready.write.parquet(path)
        frames.append(spark.read.schema(ready.schema).parquet(path))
    drawn = trial_params(n_trials, seed, rounds)
    fits = {
        t: StagedTrees(*frames, {"maxDepth": p["maxDepth"], "stepSize": p["stepSize"], "seed": seed}, patience, stage_rounds)
        for t, p in enumerate(drawn)
    }
    schema = "trial int, rung int, maxDepth int, stepSize double, rounds int, maxIter int, val_rmse double"
    going, measured = list(fits), []
    for rung in range(rungs):

        @inheritable_thread_target(spark)
        def advance(trial: int, rung: int = rung) -> tuple:
            fit, p = fits[trial], drawn[trial]
            fit.advance(rung_rounds(p["maxIter"], rungs, keep)[rung])
            kept = best_round(fit.losses, patience)
            return (trial, rung, p["maxDepth"], p["stepSize"], len(fit.trees), kept, math.sqrt(fit.losses[kept - 1]))

        with ThreadPoolExecutor(workers) as pool:
            rows = list(pool.map(advance, going))
        judged = survivors(spark.createDataFrame(rows, schema), keep).collect()
        measured += [tuple(r) for r in judged]
        going = sorted(r["trial"] for r in judged if r["goes_on"])
    trials = spark.createDataFrame(measured, schema + ", goes_on boolean")
    best = best_trial(trials).first().asDict()
    return {k: best[k] for k in ("maxDepth", "stepSize", "maxIter")}, trials


def loss_rows(spark: SparkSession, losses: dict[int, Sequence[float]]) -> DataFrame:
    """Rows (trial, round, loss) of the losses of several fits, as ``kept_rounds`` takes them."""
    rows = [(trial, i, float(loss)) for trial, fit in losses.items() for i, loss in enumerate(fit, start=1)]
    return spark.createDataFrame(rows, "trial int, round int, loss double")


_SPLIT = re.compile(r"If \(feature (\d+) (<=|in) (.+)\)")


def tree_rows(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Rows (tree, node, feature, threshold, members, below, above, value, weight) of a fitted pipeline's trees.

    Nodes are numbered from 0, the root, in each tree. An inner node sends a row whose ``feature``
    (its place in the assembled vector) is at most ``threshold``, or one of ``members`` where the
    feature is a flag, to node ``below``, any other to ``above``; a leaf has a ``value`` and no
    feature. A prediction is the sum of value times weight.
    """
    trees = model.stages[-1]
    rows = []
    for tree, (fitted, weight) in enumerate(zip(trees.trees, trees.treeWeights)):
        lines = [line.strip() for line in fitted.toDebugString.splitlines()[1:] if line.strip()]
        nodes: list[list] = []
        at = 0

        def read() -> int:
            nonlocal at
            node, line = len(nodes), lines[at]
            at += 1
            nodes.append([tree, node, None, None, None, None, None, None, float(weight)])
            if line.startswith("Predict:"):
                nodes[node][7] = float(line.split(":")[1])
                return node
            feature, kind, bound = _SPLIT.fullmatch(line).groups()
            nodes[node][2] = int(feature)
            if kind == "in":
                nodes[node][4] = [float(v) for v in bound.strip("{}").split(",")]
            else:
                nodes[node][3] = float(bound)
            nodes[node][5] = read()
            # The other side of the split stands in a line of its own.
            at += 1
            nodes[node][6] = read()
            return node

        read()
        rows += [tuple(n) for n in nodes]
    return spark.createDataFrame(
        rows,
        "tree int, node int, feature int, threshold double, members array<double>, below int, above int, value double, weight double",
    )


def best_trial(trials: DataFrame) -> DataFrame:
    """One row: the settings with the least validation error, the earliest of equals and its last rung."""
    row, order = F.struct(*trials.columns), ["val_rmse", "trial"]
    if "rung" in trials.columns:
        trials, order = trials.withColumn("__last", -F.col("rung")), [*order, "__last"]
    return trials.agg(F.min_by(row, F.struct(*order)).alias("r")).select("r.*")


def input_columns(model: Transformer) -> list[str]:
    """Columns a pipeline's assembler reads from the table; categories are left to the encoder."""
    made: set[str] = set()
    wanted: list[str] = []
    for stage in getattr(model, "stages", [model]):
        if isinstance(stage, (StringIndexerModel, OneHotEncoderModel)):
            made.add(stage.getOutputCol())
        elif isinstance(stage, VectorAssembler):
            wanted += stage.getInputCols()
    return [c for c in wanted if c not in made]


def save_model(model: PipelineModel, path: str) -> None:
    """Write encoder and trees together."""
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel | None:
    """The saved pipeline, or None where there is none."""
    try:
        return PipelineModel.load(path)
    except Exception as error:
        if "does not exist" in str(error):
            return None
        raise
