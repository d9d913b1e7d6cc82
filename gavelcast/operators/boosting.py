"""Boosting by single trees, in blocks of rounds over one stored table.

Trees are fitted one after the other, each on what the trees before it left of the label, from histograms of rows that were
binned once (``histograms``). The table holds the rows' cells, their labels and, one column per run, the sums of the trees of earlier
blocks, so they are not evaluated again; at the end of a block it is written anew, whereupon the one before is deleted. It is
read from there for each level of a tree and never cached, so a task holds one batch of rows, not its share of the vectors. No
round is fitted twice, a run can go on from where it stands or from an earlier model, and several runs (trials of a search)
share the cells of one table and the passes over it.

As in MLlib's boosting, the first tree counts fully and each later one by the learning rate. The result is a model of MLlib's;
its nodes know sizes, means and gains, but not the spread of their labels (impurity -1 in leaves).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import checkpoints, discard, scratch_path, ship
from . import histograms
from .histograms import Tree

FEATURES = "features"
LABEL = "label"
MARK = "__mark"
#: Rounds after which the sums are stored. A row passes through half as many trees, on average, per pass.
BLOCK = 16
#: Rows of a stored file, which no task need share with another.
FILE_ROWS = 250_000
#: Vectors up to this length are marked in their dense form.
DENSE = 1024


def ensemble(trees: Sequence, weights: Sequence[float]) -> GBTRegressionModel:
    """A boosted model of given trees and weights: saved, loaded and applied like any other of its class."""
    gateway = SparkContext._active_spark_context._gateway
    regression = gateway.jvm.org.apache.spark.ml.regression
    held = gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
    shares = gateway.new_array(gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        held[i], shares[i] = tree._java_obj, float(weight)
    return GBTRegressionModel(regression.GBTRegressionModel(f"boosted_{uuid.uuid4().hex[:12]}", held, shares))


def as_model(tree: Tree, bins: histograms.Bins):
    """MLlib's model of one tree."""
    gateway = SparkContext._active_spark_context._gateway
    spark = gateway.jvm.org.apache.spark
    ml, calculator = spark.ml, spark.mllib.tree.impurity.VarianceCalculator
    made: dict[int, object] = {}
    # Children come after their parent.
    for i in reversed(range(len(tree.feature))):
        n, total = tree.n[i], tree.total[i]
        sums = gateway.new_array(gateway.jvm.double, 3)
        sums[0], sums[1], sums[2] = float(n), float(total), float(total * total / n if n else 0.0)
        stats = calculator(sums, int(n))
        if tree.feature[i] < 0:
            made[i] = ml.tree.LeafNode(tree.value(i), -1.0, stats)
            continue
        split = ml.tree.ContinuousSplit(int(tree.feature[i]), bins.cut(tree.feature[i], tree.bin[i]))
        left = tree.child[i]
        made[i] = ml.tree.InternalNode(tree.value(i), -1.0, float(tree.gain[i]), made.pop(left), made.pop(left + 1), split, stats)
    return DecisionTreeRegressionModel(ml.regression.DecisionTreeRegressionModel(made[0], bins.width))


def patience_rule(errors: Sequence[float], patience: int) -> tuple[int, float, int, bool]:
    """``(best round, its error, last round, stopped)``: a run ends ``patience`` rounds past its best."""
    best, at = math.inf, 0
    for i, error in enumerate(errors, 1):
        if error < best:
            best, at = error, i
        if at and i - at >= patience:
            return at, best, i, True
    return at, best, len(errors), False


@dataclass
class Learner:
    """How one tree is to be grown."""

    depth: int
    least: int
    share: float
    seed: int


class Boosting:
    """Runs with settings of their own over the same rows, advanced block by block.

    ``arguments`` are those of ``train.boosting_arguments``, one dict per run. ``warm`` is a model from which all runs
    go on. A run samples the rows whose hash with its seed and round falls below its share, so a sample depends on the
    rows alone, not on how they are partitioned; rows equal in all features and label go together.
    """

    def __init__(self, train: DataFrame, validation: DataFrame, arguments: Sequence[dict], parallel: int = 1,
                 warm: GBTRegressionModel | None = None):
        self.spark = train.sparkSession
        checkpoints(self.spark)
        ship(self.spark)
        self.arguments = list(arguments)
        self.parallel = max(parallel, 1)
        self.first = list(warm.trees) if warm else []
        self.first_weights = list(warm.treeWeights) if warm else []
        self.trees: list[list[Tree]] = [[] for _ in self.arguments]
        self.weights: list[list[float]] = [[] for _ in self.arguments]
        self.errors: list[list[float]] = [[] for _ in self.arguments]
        # Trees whose sum the table holds.
        self.stored = 0

        first_row = train.select(FEATURES).first()
        self.rows = train.count()
        if not self.rows or validation.isEmpty():
            raise ValueError("boosting needs training and validation rows that have a label")
        width = first_row[0].size
        most = [a["maxBins"] for a in self.arguments]
        self.bins = histograms.find_bins(train, FEATURES, width, self.rows, most, self.arguments[0]["seed"])

        def begun(rows, *more):
            before = F.lit(0.0)
            if warm:
                rows = ensemble(self.first, self.first_weights).setFeaturesCol(FEATURES).setPredictionCol("__warm").transform(rows)
                before = F.col("__warm")
            sums = [before.alias(self._sum(i)) for i in range(len(self.arguments))]
            rows = rows.select(FEATURES, F.col(LABEL).cast("double").alias(LABEL), *more, *sums)
            cells = {one: self._cells(one) for one in self.bins}
            return histograms.binned(rows, self.bins, cells, FEATURES, rows.columns[1:])

        # Equal vectors have one mark, however they are held.
        vector = array_to_vector(vector_to_array(FEATURES)) if width <= DENSE else F.col(FEATURES)
        mark = F.lit(0).cast("long") if all(map(self.whole, range(len(self.arguments)))) else F.xxhash64(vector, LABEL)
        self.records = self._stored(begun(train, mark.alias(MARK)), "boosting")
        self.judged = self._stored(begun(validation), "boosting-validation")
        self.tasks = self.records[0].rdd.getNumPartitions()

    @property
    def train(self) -> tuple[DataFrame, str]:
        """The rows of the stored table, and its path."""
        kept = {n: "long" if n == MARK else "double" for n in self.records[0].columns}
        return histograms.unbinned(self.records[0], self.bins, {one: self._cells(one) for one in self.bins}, kept), self.records[1]

    @staticmethod
    def _sum(run: int) -> str:
        return f"__sum_{run}"

    @staticmethod
    def _cells(bins: int) -> str:
        return f"__cells_{bins}"

    def _stored(self, rows: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = scratch_path(self.spark, name)
        # Cells are so few bytes that files of whole tasks would leave cores idle.
        rows.write.option("maxRecordsPerFile", max(1, FILE_ROWS // histograms.RECORD_ROWS)).parquet(path)
        # Tasks take files of equal size in the order given; a folder may list them in any, and sums would differ in the last digit.
        files = sorted(map(unquote, self.spark.read.schema(rows.schema).parquet(path).inputFiles()))
        return self.spark.read.schema(rows.schema).parquet(*(files or [path])), path

    @staticmethod
    def _grower(arguments: dict, round_number: int) -> Learner:
        strategy = arguments["featureSubsetStrategy"]
        return Learner(arguments["maxDepth"], arguments["minInstancesPerNode"], 1.0 if strategy == "all" else float(strategy),
                       arguments["seed"] + round_number)

    def _learner(self, arguments: dict, round_number: int) -> Learner:
        return self._grower(arguments, round_number)

    @staticmethod
    def _lead(arguments: dict, rounds: int) -> list[Learner]:
        """The first block of a run that takes all rows."""
        return [Boosting._grower(arguments, number) for number in range(rounds)]

    def whole(self, run: int) -> bool:
        """Whether every round of the run takes all rows."""
        return self.arguments[run]["subsamplingRate"] >= 1

    def _sample(self, arguments: dict, round_number: int) -> tuple[int, int, int] | None:
        share = round(arguments["subsamplingRate"] * histograms.SHARES)
        # Of a handful of rows a sample may be empty.
        if share >= histograms.SHARES or self.rows < 50:
            return None
        return arguments["seed"], round_number, share

    def _learners(self, run: int, rounds: int) -> list[Learner]:
        arguments, first, done = self.arguments[run], len(self.first), len(self.trees[run])
        if not done and not first and self.whole(run):
            return self._lead(arguments, rounds)
        return [self._learner(arguments, number) for number in range(first + done, first + done + rounds)]

    def _fit_blocks(self, runs: Sequence[int], rounds: int) -> None:
        """``rounds`` more trees of each run, tree by tree, all runs in the same passes."""
        learners = {run: self._learners(run, rounds) for run in runs}
        for step in range(rounds):
            growing = []
            for run in runs:
                arguments, learner = self.arguments[run], learners[run][step]
                sample = self._sample(arguments, len(self.first) + len(self.trees[run]))
                growing.append(histograms.Growing(
                    self.bins[arguments["maxBins"]], self._cells(arguments["maxBins"]), self._sum(run), self.trees[run][self.stored:],
                    self.weights[run][self.stored:], learner.depth, learner.least, learner.share, learner.seed, sample))
            grown = histograms.grow(self.records[0], LABEL, MARK, growing, self.tasks, self.parallel)
            for run, tree in zip(runs, grown):
                # MLlib's step is half the learning rate; see train.boosting_arguments.
                self.weights[run].append(2 * self.arguments[run]["stepSize"] if self.first or self.trees[run] else 1.0)
                self.trees[run].append(tree)

    def _judge(self, run: int, before: int) -> None:
        """One pass for the errors after each of the rounds past ``before``."""
        most = self.arguments[run]["maxBins"]
        rows = self.judged[0].select(self._cells(most), LABEL, self._sum(run))
        errors = histograms.squares(rows, self.bins[most], self.trees[run][self.stored:], self.weights[run][self.stored:], before - self.stored)
        self.errors[run] += [math.sqrt(e) for e in errors]

    def advance(self, runs: Sequence[int], rounds: int = BLOCK, last: bool = False) -> None:
        """Fit ``rounds`` more trees in each of ``runs``; the others cannot go on after this.

        Once a block of trees is not in the table yet it is written anew, unless this is the ``last`` call.
        """
        before = len(self.trees[runs[0]])
        self._fit_blocks(runs, rounds)
        with ThreadPoolExecutor(max_workers=self.parallel) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(lambda run: self._judge(run, before)), runs))
        if last:
            return self.close()
        trees = len(self.trees[runs[0]])
        if trees - self.stored < BLOCK:
            return

        def moved(rows):
            steps = []
            for run in runs:
                most = self.arguments[run]["maxBins"]
                steps.append((self._sum(run), self._cells(most), self.bins[most], self.trees[run][self.stored:], self.weights[run][self.stored:]))
            return histograms.moved(rows, steps)

        old = self.records, self.judged
        self.records = self._stored(moved(self.records[0]), "boosting")
        self.judged = self._stored(moved(self.judged[0]), "boosting-validation")
        self.stored, self.tasks = trees, self.records[0].rdd.getNumPartitions()
        self._drop(old)

    def model(self, run: int, rounds: int) -> GBTRegressionModel:
        """The run's model after so many rounds of its own, besides those it started from."""
        bins = self.bins[self.arguments[run]["maxBins"]]
        own = [as_model(tree, bins) for tree in self.trees[run][:rounds]]
        return ensemble([*self.first, *own], [*self.first_weights, *self.weights[run][:rounds]])

    def close(self) -> None:
        """Delete the stored tables."""
        self._drop((self.records, self.judged))

    def _drop(self, tables) -> None:
        for _, path in tables:
            discard(self.spark, path)
