"""Predictive modelling: splitting, preprocessing, tuning, evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.operators import boosting, forests, quality
from brightloom.operators.anomaly import zscore_scale
from brightloom.operators.features import fold_of, importance_table, label_encode
from brightloom.operators.ranking import running_totals, value_ranges, with_stats
from brightloom.session import measured, spread


def train_test_split(df: DataFrame, key: str, train_share: float = 0.8) -> DataFrame:
    """Add ``is_train`` from the md5 of the key: stable under re-reads, retries and repartitioning."""
    bound = format(int(train_share * 16**8), "08x")
    return df.withColumn("is_train", F.md5(F.col(key).cast("string")) < bound)


def model_preprocess(df: DataFrame, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Impute, encode and scale ``df`` with statistics of ``train`` only; adds ``<c>_z`` columns.

    A category not seen in training gets code -1.
    """
    fitted = quality.impute_mean_mode(train, numeric, categorical)
    out = quality.impute_mean_mode(df, numeric, categorical, fit_on=train)
    for c in categorical:
        code = f"{c}_code"
        out = label_encode(out, c, code, fit_on=fitted).withColumn(code, F.coalesce(code, F.lit(-1)))
        fitted = label_encode(fitted, c, code)
    return zscore_scale(out, [*numeric, *[f"{c}_code" for c in categorical]], fit_on=fitted)


def _search_space(max_trees: int) -> dict[str, tuple[float, float, bool]]:
    """Ranges of the searched settings: 100 to ``max_trees`` trees, depth 3-10, rate 0.01-0.1, least leaf weight 1-7, row and column shares 0.6-1."""
    return boosting.SPACE | {"maxIter": (min(boosting.SPACE["maxIter"][0], max_trees), max_trees, True)}


@dataclass(frozen=True)
class BinnedTrees:
    """Boosted trees over bins, with the edges that bin raw ``features``."""

    edges: list[list[float]]
    model: GBTClassificationModel | boosting.Boosted

    @property
    def featureImportances(self):  # as of Spark's own models
        return self.model.featureImportances

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``rawPrediction``, ``probability`` and ``prediction``."""
        values, names = [f"__f{i}" for i in range(len(self.edges))], [f"__b{i}" for i in range(len(self.edges))]
        a = vector_to_array("features")
        out = forests.binned(df.withColumns({v: a[i] for i, v in enumerate(values)}), values, self.edges, names)
        if isinstance(self.model, boosting.Boosted):
            return self.model.transform(out, names).drop(*values, *names)
        out = VectorAssembler(inputCols=names, outputCol="__bins").transform(out)
        return self.model.transform(out, {self.model.featuresCol: "__bins"}).drop(*values, *names, "__bins")


def _counted_parts(data: DataFrame, columns: Sequence[str], edges: list[list[float]], parts: int = 4) -> DataFrame:
    """``(features, label, fold, n)``: rows alike in bins, label and fold as their number ``n``, in up to ``parts`` parts, as a subsample draws parts."""
    names = [f"b{i}" for i in range(len(columns))]
    groups = forests.binned(data, columns, edges, names).groupBy(*names, "label", "fold").agg(F.count("*").alias("rows"))
    cut = groups.withColumn("cuts", F.least("rows", F.lit(parts))).withColumn("part", F.explode(F.sequence(F.lit(1), F.col("cuts").cast("int"))))
    n = F.floor(F.col("rows") / F.col("cuts")) + (F.col("part") <= F.col("rows") % F.col("cuts")).cast("long")
    return measured(VectorAssembler(inputCols=names, outputCol="features").transform(cut.withColumn("n", n.cast("double"))).select("features", "label", "fold", "n"))


def _cells(data: DataFrame, columns: Sequence[str], edges: list[list[float]], folds: int) -> boosting.Cells | None:
    """The numbers of rows alike in bins, by fold and class, or None if they are more than a task holds."""
    names = [f"b{i}" for i in range(len(columns))]
    binned = forests.binned(data, columns, edges, names).groupBy(*[F.col(c).cast("int").alias(c) for c in names])
    counts = [F.count_if((F.col("fold") == f) & (F.col("label") == y)).alias(f"n{f}_{y}") for f in range(folds) for y in (0, 1)]
    cells = measured(binned.agg(*counts, F.count_if(~F.col("label").isin(0, 1)).alias("other")))
    size, other = cells.agg(F.count("*"), F.sum("other")).first()
    if other:
        raise ValueError(f"labels other than 0 and 1 in {other} rows")
    if size * (len(columns) + 2 * folds) > boosting.MOST_VALUES:
        return None
    found = cells.drop("other").orderBy(*names).toPandas()
    return boosting.Cells(found[names].to_numpy(np.uint8), found.drop(columns=names).to_numpy(np.int64).reshape(-1, folds, 2))


def tune_boosted_trees(
    df: DataFrame, columns: Sequence[str], label: str, budget: int = 50, folds: int = 5, seed: int = 42, max_trees: int = 1000,
    parallelism: int = 4, settings: Sequence[Mapping] | None = None,
):
    """Search of boosted trees by cross-validated ROC AUC, refitted on all rows.

    Returns ``(model, trials)`` with one row per setting. ``budget`` settings are tried in ``folds`` fits each: ten random ones, then
    one after the other where tree-structured Parzen estimators of all trials before expect the best (``boosting.propose``).
    ``settings`` are instead tried as they are, by Spark's own trees, whose parameters they name.
    Missing features count as their column's mean; rows without a label are left out. Folds are dealt by the hash
    of the row, so they don't depend on partitions. Trees split between 32 bins, so rows alike in their bins, label and fold
    are counted once, and the fits are weighted ones over the counts, whose number does not grow with the rows. The search fits
    one model per task over them (``boosting.fit``); where they are more than a task holds, it fits Spark's trees, too, which pass
    over them once per level, ``parallelism`` fits at a time.
    """
    spark = df.sparkSession
    data = spread(df.filter(F.col(label).isNotNull()).select(*[F.col(c).cast("double").alias(c) for c in columns], F.col(label).cast("double").alias("label")))
    data = fold_of(quality.impute_mean_mode(data, list(columns), []), folds, *columns, "label")
    edges = forests.bin_edges(data, columns)
    cells = None if settings else _cells(data, columns, edges, folds)
    if cells is not None:
        trials = boosting.search(boosting.cross_validated(spark, cells, seed), _search_space(max_trees), budget, seed)
        model = boosting.fitted_to_all(spark, cells, max(trials, key=lambda t: t[1])[0], seed)
    else:
        model, trials = _by_spark(_counted_parts(data, columns, edges), folds, seed, parallelism, settings, budget, max_trees)
    rows = [(i, str(s), float(a)) for i, (s, a) in enumerate(trials)]
    return BinnedTrees(edges, model), spark.createDataFrame(rows, "trial int, settings string, auc double")


def _by_spark(counted: DataFrame, folds: int, seed: int, parallelism: int, settings: Sequence[Mapping] | None, budget: int, max_trees: int):
    """``(model, trials)`` of Spark's trees over counted groups, for ``settings`` or searched ones."""
    counted = counted.repartition(counted.sparkSession.sparkContext.defaultParallelism).persist()
    judge = BinaryClassificationEvaluator(metricName="areaUnderROC", weightCol="n")

    def fit(setting: Mapping, train: DataFrame) -> GBTClassificationModel:
        least = setting.get("minInstancesPerNode", 1)  # in rows, not groups
        rows = train.agg(F.sum("n")).first()[0]
        given = {**setting, "minInstancesPerNode": 1, "minWeightFractionPerNode": min(0.49, (least - 0.5) / rows)}
        if isinstance(share := given.get("featureSubsetStrategy"), float):
            given["featureSubsetStrategy"] = f"{min(share, 0.999):.3f}"
        return GBTClassifier(featuresCol="features", labelCol="label", weightCol="n", seed=seed, **given).fit(train)

    def score(task: tuple[Mapping, int]) -> float:
        setting, fold = task
        return judge.evaluate(fit(setting, counted.filter(F.col("fold") != fold)).transform(counted.filter(F.col("fold") == fold)))

    try:
        with ThreadPool(parallelism) as pool:

            def scores(space: Sequence[Mapping]) -> np.ndarray:
                found = pool.map(score, [(s, fold) for s in space for fold in range(folds)], chunksize=1)
                return np.array(found).reshape(len(space), folds).mean(axis=1)

            trials = list(zip(settings, scores(settings))) if settings else boosting.search(scores, _search_space(max_trees), budget, seed)
        return fit(max(trials, key=lambda t: t[1])[0], counted), trials
    finally:
        counted.unpersist()


def feature_importance_table(spark_df: DataFrame, columns: Sequence[str], model) -> DataFrame:
    return importance_table(spark_df, columns, model.featureImportances.toArray())


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(actual, predicted, n)`` for all classes seen on either side, empty cells included."""
    cells = measured(
        df.groupBy(F.col(label).cast("string").alias("actual"), F.col(prediction).cast("string").alias("predicted")).agg(F.count("*").alias("n"))
    )
    classes = cells.select(F.explode(F.array("actual", "predicted")).alias("c")).distinct()
    grid = with_stats(classes.withColumnRenamed("c", "actual"), classes.agg(F.collect_set("c"))).select("actual", F.explode("__s").alias("predicted"))
    return grid.join(cells, ["actual", "predicted"], "left").select("actual", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(item, precision, recall, f1, support)`` per class, then accuracy, macro avg and weighted avg."""
    m = measured(confusion_matrix(df, label, prediction))
    hit = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    by_actual = m.groupBy(F.col("actual").alias("item")).agg(hit.alias("tp"), F.sum("n").alias("support"))
    by_predicted = m.groupBy(F.col("predicted").alias("item")).agg(F.sum("n").alias("chosen"))
    zero = F.lit(0.0)
    per = by_actual.join(by_predicted, "item").select(
        "item", "tp", "support", F.coalesce(F.try_divide("tp", "chosen"), zero).alias("precision"), F.coalesce(F.try_divide("tp", "support"), zero).alias("recall")
    )
    p, r = F.col("precision"), F.col("recall")
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * p * r, p + r), zero))
    cols = ["item", "precision", "recall", "f1", "support"]
    total = F.sum("support")
    acc = F.sum("tp") / total
    accuracy = per.agg(F.lit("accuracy").alias("item"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"), total.alias("support"))
    macro = per.agg(F.lit("macro avg").alias("item"), *[F.avg(c).alias(c) for c in cols[1:4]], total.alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("item"), *[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in cols[1:4]], total.alias("support"))
    return per.select(*cols).unionByName(accuracy).unionByName(macro).unionByName(weighted)


def _roc_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: positives, negatives and both counts above it (from independent score ranges)."""
    y = F.col(label).cast("int")
    per = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(y).cast("long").alias("pos"), F.sum(1 - y).cast("long").alias("neg")
    )
    ranged = value_ranges(per, "threshold", descending=True)
    above = running_totals(ranged, [F.desc("threshold")], F.col("__range"), {"pos_above": F.col("pos"), "neg_above": F.col("neg")})
    return with_stats(above, per.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))), "all")


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve; tied scores count half."""
    area = F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2))
    c = _roc_counts(df, label, score)
    return c.agg(F.try_divide(area, F.max(F.col("all.p").cast("double") * F.col("all.n"))).alias("auc"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """``(threshold, fpr, tpr)``: rates when every score at or above the threshold is called positive."""
    c = _roc_counts(df, label, score)
    return c.select(
        "threshold", F.try_divide(F.col("neg_above") + F.col("neg"), F.col("all.n")).alias("fpr"),
        F.try_divide(F.col("pos_above") + F.col("pos"), F.col("all.p")).alias("tpr"),
    )


def linear_regression(df: DataFrame, y: str, x: str) -> DataFrame:
    return df.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n")
    )


def multiple_regression(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """``(term, coefficient)`` of the least-squares fit over complete rows, the intercept included."""
    d = VectorAssembler(inputCols=list(xs), outputCol="features").transform(df.select(*xs, y).na.drop())
    m = LinearRegression(featuresCol="features", labelCol=y, regParam=0.0).fit(d)
    rows = [("intercept", float(m.intercept)), *[(c, float(v)) for c, v in zip(xs, m.coefficients)]]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double")


def modelling_workflow(
    df: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str], label: str, settings: Sequence[Mapping] | None = None, budget: int = 50, folds: int = 5
) -> DataFrame:
    """Split, preprocess on the train part, tune, evaluate on the test part: ``(section, item, value)``."""
    parts = train_test_split(spread(df.select(*dict.fromkeys([key, *numeric, *categorical, label]))), key)
    train = parts.filter("is_train")
    cols = [f"{c}_z" for c in (*numeric, *[f"{c}_code" for c in categorical])]
    ready = measured(model_preprocess(parts, train, numeric, categorical).select(*cols, label, "is_train"))
    model, trials = tune_boosted_trees(ready.filter("is_train"), cols, label, budget, folds, settings=settings)
    test = VectorAssembler(inputCols=cols, outputCol="features").transform(ready.filter("NOT is_train"))
    scored = measured(
        model.transform(test).select(F.col(label).cast("int").alias("y"), F.col("prediction").cast("int").alias("p"), vector_to_array("probability")[1].alias("s"))
    )
    report = classification_report(scored, "y", "p").select(F.lit("report_f1").alias("section"), "item", F.col("f1").alias("value"))
    auc = roc_auc(scored, "y", "s").select(F.lit("test").alias("section"), F.lit("roc_auc").alias("item"), F.col("auc").alias("value"))
    imp = feature_importance_table(df, cols, model).select(F.lit("importance").alias("section"), F.col("feature").alias("item"), F.col("importance").alias("value"))
    best = trials.agg(F.lit("search").alias("section"), F.lit("best_cv_auc").alias("item"), F.max("auc").alias("value"))
    return report.unionByName(auc).unionByName(imp).unionByName(best)
