"""Feature engineering: bins, encodings and feature selection."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import PCA, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from brightloom.functions.numeric import digamma, numeric_columns
from brightloom.operators import forests
from brightloom.operators.quality import impute_mean_mode
from brightloom.operators.ranking import exact_quantiles, framed, running_totals, split_row_number, text_bucket, value_ranges, with_stats
from brightloom.operators.relational import categorical_interactions, numeric_interactions, numeric_transforms
from brightloom.session import measured, spread


def quantile_bins(df: DataFrame, columns: Sequence[str], bins: int = 10, suffix: str = "_bin") -> DataFrame:
    """Add the quantile bin of every column: labels from 0, right-closed, lowest value included, equal edges merged."""
    names = [f"e{i}" for i in range(bins)]
    q = exact_quantiles(df, columns, {n: i / bins for i, n in enumerate(names)})
    # a lower edge counts once: null where it repeats the one before
    distinct = [F.col("e0").alias("e0")] + [
        F.when(F.col(names[i]) != F.col(names[i - 1]), F.col(names[i])).alias(names[i]) for i in range(1, bins)
    ]
    edges = q.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct(*distinct)))))  # one entry per column
    out = with_stats(df, edges)
    out = out.withColumns({f"__e_{c}": F.col("__s")[F.lit(c)] for c in columns})
    new = {}
    for c in columns:
        x = f"CAST(`{c}` AS DOUBLE)"
        below = " + ".join(f"coalesce(CAST(`__e_{c}`.{n} < {x} AS INT), 0)" for n in names)
        new[f"{c}{suffix}"] = F.expr(f"CASE WHEN {x} IS NOT NULL THEN greatest({below} - 1, 0) END")
    return out.withColumns(new).drop("__s", *[f"__e_{c}" for c in columns])


def _attach(df: DataFrame, c: str, table: DataFrame) -> DataFrame:
    """Left join on one column with a written table, so Spark broadcasts or sorts by its measured size."""
    t = measured(table).withColumnRenamed(c, "__k")
    return df.join(t, F.col(c) == F.col("__k"), "left").drop("__k")


def rolling_features(df: DataFrame, columns: Sequence[str], order: str, tie: str, size: int = 7, by: Sequence[str] = ()) -> DataFrame:
    """Add ``<c>_rolling_mean`` and ``<c>_rolling_std`` over the last ``size`` rows by ``order``, then ``tie``; null until there are as many values."""

    def columns_of(w: WindowSpec) -> dict[str, Column]:
        w = w.rowsBetween(-(size - 1), 0)
        out = {}
        for c in columns:
            full = F.count(c).over(w) == size
            out |= {f"{c}_rolling_mean": F.when(full, F.avg(c).over(w)), f"{c}_rolling_std": F.when(full, F.stddev_samp(c).over(w))}
        return out

    return framed(df, order, columns_of, before=size - 1, by=by, tie=tie)


def count_encode(df: DataFrame, c: str) -> DataFrame:
    """Add ``<c>_count``; null stays null."""
    return _attach(df, c, df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias(f"{c}_count")))


def freq_encode(df: DataFrame, c: str) -> DataFrame:
    """Add ``<c>_freq``, the share among non-null values."""
    counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("__n"))
    total = df.agg(F.count(c)).scalar()
    return _attach(df, c, counts.select(c, (F.col("__n") / total).alias(f"{c}_freq")))


SMOOTH_AT, SMOOTH_WIDTH = 20, 10  # fixed values: sample size at half weight and its scale


def target_encode(df: DataFrame, c: str, target: str) -> DataFrame:
    """Add ``<c>_target``: category mean of the target shrunk to the overall mean by a logistic weight of its size."""
    per = df.groupBy(c).agg(F.avg(target).alias("__m"), F.count(target).alias("__n"))
    prior = df.agg(F.avg(target)).scalar()
    w = 1 / (1 + F.exp(-(F.col("__n") - SMOOTH_AT) / SMOOTH_WIDTH))
    enc = per.filter(F.col(c).isNotNull()).select(c, (prior * (1 - w) + F.col("__m") * w).alias(f"{c}_target"))
    return _attach(df, c, enc).withColumn(f"{c}_target", F.coalesce(f"{c}_target", prior))


def one_hot(df: DataFrame, c: str, max_levels: int = 10) -> DataFrame:
    """Add 0/1 columns ``<c>_<value>`` when there are fewer than ``max_levels`` values, else return ``df`` unchanged."""
    levels = [r[0] for r in df.select(c).filter(F.col(c).isNotNull()).distinct().limit(max_levels).collect()]
    if len(levels) >= max_levels:
        return df
    return df.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for v in sorted(levels)})


def label_encode(df: DataFrame, c: str, name: str | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """Add alphabetical codes 0..k-1 as ``<c>_code``. Distinct values are numbered in independent ranges."""
    src = df if fit_on is None else fit_on
    levels = src.select(F.col(c).cast("string").alias("v")).filter(F.col("v").isNotNull()).distinct()
    codes = split_row_number(levels, [F.asc("v")], text_bucket(levels, "v"), (), "__code")
    codes = measured(codes.select("v", (F.col("__code") - 1).alias(name or f"{c}_code")))
    return df.join(codes, F.col(c).cast("string") == F.col("v"), "left").drop("v")


def mutual_information(df: DataFrame, columns: Sequence[str], target: str, k: int = 3) -> DataFrame:
    """``(feature, mi)`` in nats between columns and a class, from distances to the ``k``-th nearest row of the same class.

    For every row that distance and the number of rows of all classes nearer than it are compared. Where ``k`` rows of the
    class have the row's own value, the rows with that value are counted in the class and in all. Equal values are counted before
    anything is ordered; neighbours come from frames of at most ``k`` values on either side, counts of nearer rows
    from running totals in which the ends of all distances are placed among the values. Neither holds a series in one task.
    Classes of one row, and missing values, are left out.
    """
    long = df.select(F.col(target).cast("string").alias("y"), *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(["y"], list(columns), "feature", "v")
    long = long.filter(F.col("y").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v"))
    cells = measured(long.groupBy("feature", "y", F.expr("v + 0.0").alias("v")).agg(F.count("*").alias("c")))
    classes = measured(cells.groupBy("feature", "y").agg(F.sum("c").alias("ny")).filter("ny > 1"))
    cells = cells.join(classes, ["feature", "y"])

    def near(w: WindowSpec) -> dict[str, Column]:
        around = [F.lag(F.struct("v", "c"), -i).over(w) if i else F.struct("v", "c") for i in range(-k, k + 1)]
        return {"near": F.array(*around)}

    @F.arrow_udf("struct<d: double, u: double>")
    def reach(near: pa.Array, wanted: pa.Array) -> pa.Array:
        """Distance and place of the value with which ``wanted`` rows are reached: nearer values first, then smaller ones."""
        cells = near.flatten()
        u, c = (cells.field(i) if not cells.null_count else pc.struct_field(cells, i) for i in (0, 1))
        u, c = (x.to_numpy(zero_copy_only=False).astype(float).reshape(len(near), 2 * k + 1) for x in (u, pc.fill_null(c, 0)))
        c[:, k] -= 1  # the row itself
        d = np.where(np.isnan(u), np.inf, np.abs(u - u[:, k : k + 1]))
        order = np.argsort(d, axis=1, kind="stable")
        there = np.cumsum(np.take_along_axis(c, order, 1), axis=1) >= wanted.to_numpy(zero_copy_only=False)[:, None]
        at = np.take_along_axis(order, there.argmax(axis=1)[:, None], 1)
        return pa.StructArray.from_arrays([pa.array(np.take_along_axis(x, at, 1)[:, 0]) for x in (d, u)], ["d", "u"])

    d = framed(cells, "v", near, before=k, after=k, by=["feature", "y"])
    wanted = F.least(F.lit(k).cast("long"), F.col("ny") - 1)
    d = d.withColumn("wanted", wanted).withColumn("r", reach("near", "wanted"))
    same = F.col("r.d") == 0
    low = F.when(F.col("r.u") < F.col("v"), F.col("r.u")).otherwise(F.col("v") - F.col("r.d"))
    high = F.when(F.col("r.u") > F.col("v"), F.col("r.u")).otherwise(F.col("v") + F.col("r.d"))
    d = measured(d.select("feature", "y", "v", "c", "ny", F.when(same, F.col("c")).otherwise(F.col("wanted")).alias("kk"), same.alias("same"), low.alias("low"), high.alias("high")))
    # a row before the values equal to it has kind 0, after them 2; distances leave out their ends, equal values are counted
    values = d.groupBy("feature", F.col("v").alias("at")).agg(F.sum("c").alias("n")).select("feature", "at", F.lit(1).alias("kind"), "n")
    ends = F.array(
        F.struct(F.col("low").alias("at"), F.when(F.col("same"), 0).otherwise(2).alias("kind"), F.lit(-1).alias("side")),
        F.struct(F.col("high").alias("at"), F.when(F.col("same"), 2).otherwise(0).alias("kind"), F.lit(1).alias("side")),
    )
    asked = d.select("feature", "y", "v", "c", "ny", "kk", F.inline(ends))  # what the gain needs goes along, so that nothing is joined
    placed = value_ranges(measured(values.unionByName(asked, allowMissingColumns=True)), "at")
    totals = running_totals(placed, [F.asc("at"), F.asc("kind"), F.asc("y"), F.asc("v")], F.col("__range"), {"before": F.coalesce("n", F.lit(0))}, ["feature"])
    rows = totals.filter("kind <> 1").groupBy("feature", "y", "v").agg(
        F.sum(F.coalesce("before", F.lit(0)) * F.col("side")).alias("m"), *[F.max(x).alias(x) for x in ("c", "ny", "kk")]
    )
    gain = F.col("c") * (digamma(F.col("kk")) - digamma(F.col("ny")) - digamma(F.col("m")))
    return rows.groupBy("feature").agg(F.greatest(digamma(F.sum("c")) + F.sum(gain) / F.sum("c"), F.lit(0.0)).alias("mi"))


def _vectors(df: DataFrame, columns: Sequence[str], target: str, keep: Sequence[str] = ()) -> DataFrame:
    """Assembled features, alphabetically indexed label and the ``keep`` columns. Missing values count as their
    column's mean; only rows without a target are left out, as there is nothing to learn from them. A small table is dealt to
    all cores, as it may be a single row group."""
    d = spread(df.filter(F.col(target).isNotNull()).select(*keep, *[F.col(c).cast("double").alias(f"__f_{c}") for c in columns], F.col(target).cast("string").alias("__t")))
    mean = d.agg(*[F.avg(f"__f_{c}") for c in columns]).first()
    filled = d.select(*keep, "__t", *[F.coalesce(f"__f_{c}", F.lit(m or 0.0)).alias(f"__f_{c}") for c, m in zip(columns, mean)])
    index = StringIndexer(inputCol="__t", outputCol="label", stringOrderType="alphabetAsc")
    return Pipeline(stages=[VectorAssembler(inputCols=[f"__f_{c}" for c in columns], outputCol="features"), index]).fit(filled).transform(filled)


def fold_of(df: DataFrame, folds: int, *columns: str) -> DataFrame:
    """Add ``fold`` from the hash of the columns: the same rows meet in a fold however the data are partitioned."""
    return df.withColumn("fold", F.pmod(F.xxhash64(*columns), F.lit(folds)).cast("int"))


def _forest(trees: int, seed: int = 42, max_depth: int = 10) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, seed=seed, maxDepth=max_depth)


def _classes(data: DataFrame) -> int:
    return len(data.schema["label"].metadata["ml_attr"]["vals"])


def _flat(data: DataFrame, n: int) -> DataFrame:
    a = vector_to_array("features")
    return data.select(*[a[i].alias(f"f{i}") for i in range(n)], "label")


def _forest_importances(data: DataFrame, left: Sequence[int], trees: int, seed: int, counted: DataFrame | None = None) -> np.ndarray:
    """Importances of the features ``left`` in a forest over ``features`` and ``label``, as of one fitted to all rows.

    With the ``counted`` groups of rows alike in their bins and label, all trees grow over these, whose number does not grow with the
    rows. Without, rows are passed over one by one.
    """
    if counted is None:
        sliced = VectorSlicer(inputCol="features", outputCol="left", indices=list(left)).transform(data)
        return _forest(trees, seed).setFeaturesCol("left").fit(sliced).featureImportances.toArray()
    names = [f"b{i}" for i in left]
    packed = forests.blocks(counted.groupBy(*names, "label").agg(F.sum("n").alias("n")), names)
    return forests.grow(packed, len(names), _classes(data), trees, 10, seed).importances(len(names))


class _Groups:
    """Forests over rows counted by their bins of all features and label, however many such groups there are.

    Bins and counts are found once. Groups are merged again when half of the features packed with them have been dropped, not at every refit.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str], target: str):
        data = _vectors(df, columns, target).select("features", "label")
        self.classes, self.features = _classes(data), len(columns)
        self.counted, self.held, self.packed, self.found = _counted_bins(data, len(columns), always=True), [], None, {}

    def importances(self, left: Sequence[int], trees: int, seed: int) -> np.ndarray:
        """As ``_forest_importances``; the same forest is grown once."""
        asked = (tuple(left), trees, seed)
        if asked not in self.found:
            if not set(left) <= set(self.held) or 2 * len(left) <= len(self.held):
                names = [f"b{i}" for i in left]
                self.held, self.packed = list(left), forests.blocks(self.counted.groupBy(*names, "label").agg(F.sum("n").alias("n")), names)
            grown = forests.grow(self.packed, len(left), self.classes, trees, 10, seed, [self.held.index(i) for i in left])
            self.found[asked] = grown.importances(len(left))
        return self.found[asked]


def _counted_bins(data: DataFrame, n: int, always: bool = False) -> DataFrame | None:
    """The groups of rows with equal bins and label with their size ``n``, or None if there are hardly fewer of them than rows (unless ``always``)."""
    names, values = [f"b{i}" for i in range(n)], [f"f{i}" for i in range(n)]
    if not always and not data.take(1):
        return None
    flat = _flat(data, n)
    counted = forests.binned(flat, values, forests.bin_edges(flat, values), names).groupBy(*names, "label").agg(F.count("*").alias("n"))
    counted = measured(counted)
    if always:
        return counted
    rows, groups = counted.agg(F.sum("n"), F.count("*")).first()
    return counted if 2 * groups <= rows else None


@contextmanager
def _for_forests(df: DataFrame, columns: Sequence[str], target: str) -> Iterator[tuple[DataFrame, DataFrame | None]]:
    """Rows for forests and their counted groups; where groups do not help, the rows are dealt to all cores and cached."""
    data = _vectors(df, columns, target).select("features", "label")
    counted = _counted_bins(data, len(columns))
    if counted is not None:
        yield data, counted
        return
    data = data.repartition(data.sparkSession.sparkContext.defaultParallelism).persist()
    try:
        yield data, None
    finally:
        data.unpersist()


def importance_table(df: DataFrame, columns: Sequence[str], importances) -> DataFrame:
    """``(feature, importance)`` of a fitted model, highest first."""
    rows = sorted(zip(columns, [float(v) for v in importances]), key=lambda r: (-r[1], r[0]))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def rf_importance(df: DataFrame, columns: Sequence[str], target: str, trees: int = 100, seed: int = 42, groups: _Groups | None = None) -> DataFrame:
    """``(feature, importance)`` of a forest, over ``groups`` if there are such of these columns."""
    if groups is not None:
        return importance_table(df, columns, groups.importances(range(len(columns)), trees, seed))
    with _for_forests(df, columns, target) as (data, counted):
        return importance_table(df, columns, _forest_importances(data, range(len(columns)), trees, seed, counted))


def recursive_elimination(
    df: DataFrame, columns: Sequence[str], target: str, keep: int, trees: int = 100, seed: int = 42, step: float = 0.0, groups: _Groups | None = None
) -> DataFrame:
    """``(feature, ranking)``: 1 = kept; the weakest features of each refit get the next rank from the end.

    Each refit drops one feature, or the share ``step`` of those left if that is more. Rows are counted by their bins
    once; a refit only sums the counts over the bins of the features left. Forests grow over ``groups`` if there are such of these columns.
    """
    left, rounds = list(range(len(columns))), []
    if len(left) > keep:
        with _for_forests(df, columns, target) if groups is None else nullcontext((None, None)) as (data, counted):
            while len(left) > keep:
                imp = _forest_importances(data, left, trees, seed, counted) if groups is None else groups.importances(left, trees, seed)
                order = sorted(range(len(left)), key=lambda i: (imp[i], columns[left[i]]))
                weakest = {left[i] for i in order[: min(max(1, int(step * len(left))), len(left) - keep)]}
                rounds.append([columns[i] for i in left if i in weakest])
                left = [i for i in left if i not in weakest]
    rows = [(columns[i], 1) for i in left]
    rows += [(c, r + 2) for r, names in enumerate(reversed(rounds)) for c in names]
    return df.sparkSession.createDataFrame(rows, "feature string, ranking int")


def select_features(
    df: DataFrame, columns: Sequence[str], target: str | None, n: int, trees: int = 100, step: float = 0.0, grouped: bool = False
) -> DataFrame:
    """``(feature, votes, importance)``: union of the top ``n`` by mutual information, forest importance and
    elimination, capped at ``n`` by votes then importance; the first ``n`` columns without a target. With ``grouped`` all forests
    grow over the same counted groups of rows, also where these are hardly fewer than the rows."""
    spark = df.sparkSession
    if target is None:
        return spark.createDataFrame([(c, 0, 0.0) for c in list(columns)[:n]], "feature string, votes int, importance double")
    mi = mutual_information(df, columns, target).orderBy(F.desc("mi"), "feature").limit(n).select("feature")
    groups = _Groups(df, columns, target) if grouped else None
    rf = measured(rf_importance(df, columns, target, trees, groups=groups))
    rfe = recursive_elimination(df, columns, target, n, trees, step=step, groups=groups).filter("ranking = 1").select("feature")
    top = rf.orderBy(F.desc("importance"), "feature").limit(n).select("feature")
    votes = mi.unionAll(top).unionAll(rfe).groupBy("feature").agg(F.count("*").cast("int").alias("votes"))
    return votes.join(rf, "feature").orderBy(F.desc("votes"), F.desc("importance"), "feature").limit(n)


def pca_optimize(
    df: DataFrame, columns: Sequence[str], target: str, ks: Sequence[int] | None = None, folds: int = 5, trees: int = 100, seed: int = 42, keep: Sequence[str] = ()
) -> tuple[int, DataFrame, DataFrame]:
    """Scale, then choose the number of components by cross-validated forest accuracy.

    Scales and components are fitted to the training rows of every fold. The components of all its rows are binned at the training
    rows' quantiles and counted by bins, and the forests grow over the counts; fewer components are the first of more. Returns
    ``(k, scores per k, rows with components)``; the rows carry ``keep`` and ``label``.
    """
    data = _vectors(df, columns, target, keep).select(*keep, "features", "label")
    data = fold_of(data.withColumn("__values", vector_to_array("features")), folds, "__values", "label")
    ks = list(ks or range(2, min(50, len(columns)) + 1))

    def reduced(rows: DataFrame, k: int) -> PipelineModel:
        scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
        return Pipeline(stages=[scaler, PCA(k=k, inputCol="scaled", outputCol="components")]).fit(rows.select("features"))

    def score(fold: int) -> list[float]:
        scale, pca = reduced(data.filter(F.col("fold") != fold), max(ks)).stages
        std, turn = scale.std.toArray(), pca.pc.toArray()
        turn = turn * np.divide(1.0, std, out=np.zeros_like(std), where=std != 0)[:, None]
        shift = scale.mean.toArray() @ turn
        values, names = [f"c{i}" for i in range(max(ks))], [f"b{i}" for i in range(max(ks))]
        placed = data.select(
            (F.col("fold") != fold).alias("train"), "label",
            *[(sum((F.col("__values")[j] * float(turn[j, i]) for j in range(len(columns))), F.lit(0.0)) - float(shift[i])).alias(c) for i, c in enumerate(values)],
        )
        edges = forests.bin_edges(placed.filter("train"), values)
        counted = measured(forests.binned(placed, values, edges, names).groupBy("train", *names, "label").agg(F.count("*").alias("n")))
        found = []
        for k in ks:
            groups = counted.groupBy("train", *names[:k], "label").agg(F.sum("n").alias("n"))
            grown = forests.grow(forests.blocks(groups.filter("train"), names[:k]), k, _classes(data), trees, 5, seed)
            found.append(forests.accuracy(forests.blocks(groups.filter("NOT train"), names[:k]), k, grown))
        return found

    with ThreadPool(4) as pool:
        means = np.mean(pool.map(score, range(folds)), axis=0)
    scores = df.sparkSession.createDataFrame([(k, float(s)) for k, s in zip(ks, means)], "k int, accuracy double")
    best = ks[int(np.argmax(means))]
    return best, scores, reduced(data, best).transform(data).select(*keep, "label", "components")


def feature_workflow(
    df: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str], target: str, n: int = 8, ks: Sequence[int] | None = None,
    folds: int = 5, trees: int = 100, date: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Engineer, select and reduce features; returns ``(rows, scores per number of components)``.

    Numeric columns get transforms, interactions and quantile bins, and with a ``date`` their mean and deviation over the last 7
    rows by date and key; categories and their pairs get counts, frequencies,
    smoothed means of the (numeric) target and, with few values, 0/1 columns. ``n`` features are selected, the elimination
    dropping one per refit, and reduced to the searched number of components. Every row with a target is kept with its ``key``, the selected features,
    the target and the components; undefined features (a logarithm of a negative number) count as the column's mean.
    """
    dates = [date] if date else []
    out = impute_mean_mode(df.select(key, *dates, *numeric, *categorical, target).filter(F.col(target).isNotNull()), numeric, categorical)
    if date:
        out = rolling_features(out, numeric, date, key).drop(date)
    out = quantile_bins(numeric_interactions(numeric_transforms(out, numeric), numeric), numeric)
    out = measured(categorical_interactions(out, categorical))
    pairs = [f"{a}_x_{b}" for i, a in enumerate(categorical) for b in categorical[i + 1 :]]
    for c in [*categorical, *pairs]:
        out = target_encode(freq_encode(count_encode(out, c), c), c, target)
    for c in categorical:
        out = one_hot(out, c)
    features = [c for c in numeric_columns(out) if c not in (key, target)]
    out = measured(out.select(key, target, *[F.col(f"`{c}`") for c in features]))
    chosen = [r["feature"] for r in select_features(out, features, target, n, trees, grouped=True).collect()]  # n names
    _, scores, rows = pca_optimize(out, chosen, target, ks, folds, trees, keep=[key, target, *chosen])
    return rows.drop("label"), scores
