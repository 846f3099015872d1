"""Estimators, training, scoring, clustering, tuning.

Spark ML does the distributed work; this module fixes the plumbing:

* labels are indexed OUTSIDE the scoring pipeline (the fitted label list travels
  with the model), so scoring never needs the label column;
* ``prediction`` is decoded back to the original label with a built-in
  ``element_at`` over the label list (no IndexToString on the truth column);
* class probabilities come out as ``p_<label>`` double columns via
  ``vector_to_array`` (no per-row Python);
* classifiers by trees over few features learn from and score by cells (a bin of each
  feature): a tree sees a row only through its bins, so rows are counted by cell and class.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, NumericType, StructField, StructType

from prepframe._session import cut_lineage
from prepframe.operators import evaluate as E
from prepframe.operators.split import HASH_SPACE, hash_bucket

# Parameter names of the original components, accepted unchanged so
# their parameter dictionaries keep working.
#   forests and trees: treeNum, criterion, maxDepth, minSamplesSplit, minSamplesLeaf
#   k-means:           K, init, n_init, max_iter, tol
KINDS = ("binary", "multiclass", "regression")
MAX_CLASSES = 10_000
# A task of a learner reads about so many rows at most, however few partitions the input has.
ROWS_PER_TASK = 1_000_000
# Classifiers by trees learn from counted cells where bins to the power of the features, times the
# classes, is at most this; of so many rows Spark's learner looks at all for its thresholds.
MAX_CELLS = 10_000
# Parameters under which a row counts through its bins and class alone.
CELL_PARAMS = {
    "featuresCol", "labelCol", "predictionCol", "classifier", "parallelism", "seed", "impurity", "maxDepth", "maxBins", "numTrees", "maxIter", "stepSize",
    "minInstancesPerNode",
}


def _classification(algo: str, params: dict, seed: int, multiclass: bool):
    from pyspark.ml import classification as C

    if algo == "random_forest":
        return C.RandomForestClassifier(
            numTrees=int(params.get("treeNum", 20)),
            impurity=params.get("criterion", "gini"),
            maxDepth=int(params.get("maxDepth", 5)),
            minInstancesPerNode=int(params.get("minSamplesLeaf", 1)),
            seed=seed,
        )
    if algo == "decision_tree":
        return C.DecisionTreeClassifier(
            impurity=params.get("criterion", "gini"), maxDepth=int(params.get("maxDepth", 5)),
            minInstancesPerNode=int(params.get("minSamplesLeaf", 1)), seed=seed,
        )
    if algo == "gbdt":
        gbt = C.GBTClassifier(maxIter=int(params.get("maxIter", 20)), maxDepth=int(params.get("maxDepth", 5)),
                              stepSize=float(params.get("stepSize", 0.1)), seed=seed)
        # GBTClassifier is binary only: multi-class runs one-vs-rest
        return C.OneVsRest(classifier=gbt) if multiclass else gbt
    if algo == "logistic_regression":
        return C.LogisticRegression(maxIter=int(params.get("maxIter", 100)), regParam=float(params.get("regParam", 0.0)),
                                    elasticNetParam=float(params.get("elasticNetParam", 0.0)),
                                    family="multinomial" if multiclass else "auto")
    if algo == "naive_bayes":
        return C.NaiveBayes(modelType=params.get("modelType", "gaussian"), smoothing=float(params.get("smoothing", 1.0)))
    if algo == "svm":
        svc = C.LinearSVC(maxIter=int(params.get("maxIter", 100)), regParam=float(params.get("regParam", 0.0)))
        return C.OneVsRest(classifier=svc) if multiclass else svc
    if algo == "mlp":
        return C.MultilayerPerceptronClassifier(layers=list(params["layers"]), maxIter=int(params.get("maxIter", 100)), seed=seed)
    raise ValueError(f"unknown classifier {algo!r}")


def _regression(algo: str, params: dict, seed: int):
    from pyspark.ml import regression as R

    if algo == "random_forest":
        return R.RandomForestRegressor(
            numTrees=int(params.get("treeNum", 20)), impurity="variance", maxDepth=int(params.get("maxDepth", 5)),
            minInstancesPerNode=int(params.get("minSamplesLeaf", 1)), seed=seed,
        )
    if algo == "decision_tree":
        return R.DecisionTreeRegressor(maxDepth=int(params.get("maxDepth", 5)), seed=seed)
    if algo == "gbdt":
        return R.GBTRegressor(maxIter=int(params.get("maxIter", 20)), maxDepth=int(params.get("maxDepth", 5)), seed=seed)
    if algo == "linear_regression":
        return R.LinearRegression(regParam=float(params.get("regParam", 0.0)),
                                  elasticNetParam=float(params.get("elasticNetParam", 0.0)),
                                  solver=params.get("solver", "auto"))
    if algo == "glm":
        return R.GeneralizedLinearRegression(family=params.get("family", "gaussian"), link=params.get("link"),
                                             regParam=float(params.get("regParam", 0.0)), maxIter=int(params.get("maxIter", 25)))
    raise ValueError(f"unknown regressor {algo!r}")


def make_estimator(kind: str, algo: str, seed: int = 42, **params):
    """Unfitted estimator (M1-M3, D36-D44).  Parameter names of the original
    components are accepted for forests (``treeNum, criterion, maxDepth,
    minSamplesSplit, minSamplesLeaf``); ``minSamplesSplit`` has no Spark twin."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    if kind == "regression":
        return _regression(algo, params, seed)
    return _classification(algo, params, seed, multiclass=(kind == "multiclass"))


@dataclass
class FittedModel:
    """A fitted ``PipelineModel`` plus what scoring needs to decode its output."""

    pipeline: PipelineModel
    features: list[str]
    kind: str
    labels: list | None = None  # class labels in index order (classification)
    label_numeric: bool = False
    extra: dict = field(default_factory=dict)

    def save(self, path: str) -> None:
        """The pipeline and, beside it, what scoring needs (labels, kind, features)."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.getActiveSession()
        labels = None if self.labels is None else [str(v) for v in self.labels]
        kinds = {bool: "boolean", int: "bigint", float: "double"}
        kind_of_label = kinds.get(type(self.labels[0]), "string") if self.labels else "string"
        features = [self.features] if isinstance(self.features, str) else list(self.features)
        row = (features, isinstance(self.features, str), self.kind, labels, kind_of_label, self.label_numeric)
        schema = "features array<string>, one_array boolean, kind string, labels array<string>, label_type string, label_numeric boolean"
        spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FittedModel":
        schema = "features array<string>, one_array boolean, kind string, labels array<string>, label_type string, label_numeric boolean"
        r = spark.read.schema(schema).json(f"{path}/meta").collect()[0]  # one row
        cast = {"boolean": lambda v: v == "True", "bigint": int, "double": float, "string": str}[r["label_type"]]
        labels = None if r["labels"] is None else [cast(v) for v in r["labels"]]
        features = r["features"][0] if r["one_array"] else list(r["features"])
        return cls(PipelineModel.load(f"{path}/pipeline"), features, r["kind"], labels, bool(r["label_numeric"]))


def _label_index(df: DataFrame, label: str) -> tuple[list, bool]:
    """Class labels in frequency order (ties by value), counted by one aggregate."""
    numeric = isinstance(df.schema[label].dataType, NumericType)
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # one row per class, collected only after the class count is bounded
    rows = counts.orderBy(F.col("n").desc(), F.col(label)).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label}: more than {MAX_CLASSES} classes; use a regression model or recode the label")
    return [r[label] for r in rows], numeric


def _encode_label(df: DataFrame, label: str, labels: list, numeric: bool, out: str = "_label_idx") -> DataFrame:
    kind = df.schema[label].dataType
    schema = StructType([StructField("_lab", kind), StructField(out, DoubleType())])
    table = df.sparkSession.createDataFrame([(v, float(i)) for i, v in enumerate(labels)], schema)
    # at most MAX_CLASSES rows, sent to the rows where they are: by label, a class would be one task
    return df.join(F.broadcast(table), F.col(label) == F.col("_lab"), "left").drop("_lab")


def _in_tasks(data: DataFrame) -> DataFrame:
    """``data`` persisted (memory and disk; lost blocks are recomputed from lineage), dealt out anew
    where it has more than ROWS_PER_TASK rows a partition."""
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    held = data.select(F.spark_partition_id().alias("_part")).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("_part").alias("parts")).collect()[0]
    tasks = -(-held["rows"] // ROWS_PER_TASK)
    if tasks <= held["parts"]:
        return data
    numbered = cut_lineage(data.withColumn("_row", F.monotonically_increasing_id()))  # the numbers stay if a task is repeated
    data.unpersist()
    return numbered.repartition(tasks, "_row").drop("_row").persist(StorageLevel.MEMORY_AND_DISK)


def _cell_bins(estimator, data: DataFrame, features: Sequence[str], n_classes: int) -> int:
    """Bins per feature if ``estimator`` can learn from counted cells, else 0."""
    from pyspark.ml import classification as C

    tree = estimator.getClassifier() if isinstance(estimator, C.OneVsRest) else estimator
    kinds = (C.DecisionTreeClassifier, C.GBTClassifier) if tree is not estimator else (C.DecisionTreeClassifier, C.GBTClassifier, C.RandomForestClassifier)
    if not isinstance(tree, kinds) or not all(isinstance(data.schema[c].dataType, NumericType) for c in features):
        return 0
    given = {p.name for e in (estimator, tree) for p in e.params if e.isSet(p)}
    if not given <= CELL_PARAMS or tree.getMinInstancesPerNode() > 1:  # counted in rows, and a cell is one row
        return 0
    return tree.getMaxBins() if n_classes * tree.getMaxBins() ** len(features) <= MAX_CELLS else 0


def _thresholds(values: Sequence[float], bins: int) -> list[float]:
    """At most ``bins`` - 1 thresholds (values up to one lie left of it) by the rule of Spark's tree
    learners: between all distinct values if they are few enough, else about equally many apart."""
    import numpy as np

    distinct, counts = np.unique(np.asarray(values, dtype=np.float64), return_counts=True)
    with np.errstate(invalid="ignore"):  # between both infinities
        halves = distinct[:-1] / 2 + distinct[1:] / 2
    middle = [float(m) if m < b else float(a) for a, b, m in zip(distinct, distinct[1:], halves)]
    if len(middle) < bins:
        return middle
    out, seen, stride = [], counts[0], len(values) / bins
    target = stride
    for i, n in enumerate(counts[1:]):
        if abs(seen - target) < abs(seen + n - target):
            out.append(middle[i])
            target += stride
        seen += n
    return out


def _bucketizer(data: DataFrame, features: Sequence[str], bins: int):
    """The features' bins, between 10,000 order statistics of all rows at equal steps (of fewer rows, each one)."""
    import math

    ranks = " ".join(str((i + 0.5) / 10_000) for i in range(10_000))
    got = data.select(*[F.col(c).cast("double").alias(f"_x_{i}") for i, c in enumerate(features)]).agg(
        *[F.expr(f"percentile_approx(_x_{i}, CAST(split('{ranks}', ' ') AS ARRAY<DOUBLE>), 10000)") for i in range(len(features))]
    ).collect()[0]  # one row
    splits = []
    for values in got:
        # a bin holds its lower end: the next double after a threshold; a feature of one value gets a split that no tree uses
        inner = [math.nextafter(t, math.inf) for t in _thresholds(values or [], bins)]
        splits.append([-math.inf, *([t for t in inner if t < math.inf] or [0.0]), math.inf])
    return Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=[f"_bin_{i}" for i in range(len(features))])


def _fit_cells(data: DataFrame, features: Sequence[str], label: str, estimator, labels: list, numeric: bool, bins: int) -> PipelineModel:
    """The pipeline (bins, assembler, model) of a classifier by trees, learnt from cells with their numbers of rows.

    One tree and boosted trees find what they find over the rows, binned alike.  A forest's
    bootstrap draws a row Poisson(1) times, so n equal rows Poisson(n) times: each cell's n is
    drawn anew for each tree."""
    import numpy as np
    from pyspark.ml import classification as C

    spark = data.sparkSession
    whole = data.where(_complete(data, features))
    bucketizer = _bucketizer(whole, features, bins)
    names = bucketizer.getOutputCols()
    at = _cell(names, bucketizer.getSplitsArray())
    counted = bucketizer.transform(whole).groupBy(at.alias("_cell"), label).agg(F.count(F.lit(1)).alias("_n"))
    got = _encode_label(counted, label, labels, numeric).select("_cell", "_label_idx", "_n").collect()  # at most MAX_CELLS rows
    got = sorted((int(r["_cell"]), r["_label_idx"], float(r["_n"])) for r in got)
    sizes = [len(s) - 1 for s in bucketizer.getSplitsArray()]
    places = [[float(b) for b in np.unravel_index(c, sizes)] for c, _, _ in got]
    draws, weights = [], ["_n"]
    if isinstance(estimator, C.RandomForestClassifier):
        rng, n = np.random.default_rng(estimator.getSeed() % 2**64), np.array([r[2] for r in got])
        for _ in range(estimator.getNumTrees()):
            drawn = rng.poisson(n).astype(float)
            draws.append(drawn if drawn.any() else n)
        weights = [f"_n_{t}" for t in range(len(draws))]
    columns = draws or [[r[2] for r in got]]
    schema = StructType([StructField(c, DoubleType()) for c in (*names, "_label_idx", *weights)])
    table = spark.createDataFrame([(*p, r[1], *(float(w[i]) for w in columns)) for i, (p, r) in enumerate(zip(places, got))], schema)
    # the number of classes goes with the column: a draw may miss a rare one
    known = {"ml_attr": {"type": "nominal", "num_vals": len(labels)}}
    assembler = VectorAssembler(inputCols=names, outputCol="_features")
    cells = assembler.transform(table).withColumn("_label_idx", F.col("_label_idx").alias("_label_idx", metadata=known))
    cells = cells.coalesce(1).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not draws:
            model = estimator.copy({estimator.weightCol: "_n"}).fit(cells)
        else:
            model = _forest(estimator, cells, weights, len(labels))
    finally:
        cells.unpersist()
    return PipelineModel([bucketizer, assembler, model])


def _forest(estimator, cells: DataFrame, weights: Sequence[str], n_classes: int):
    """A forest of one tree per weight column; as in a forest fitted at once, a node of several trees looks at sqrt(features) of them."""
    from pyspark.ml.classification import RandomForestClassificationModel

    def one(t: int):
        def job():
            single = estimator.copy({
                estimator.numTrees: 1, estimator.bootstrap: False, estimator.weightCol: weights[t], estimator.seed: estimator.getSeed() + t,
                estimator.featureSubsetStrategy: "sqrt" if len(weights) > 1 else "all",
            })
            return single.fit(cells.where(F.col(weights[t]) > 0))

        return job

    trees = _concurrently(cells.sparkSession, [one(t) for t in range(len(weights))], POOLS)
    sc = cells.sparkSession.sparkContext
    kind = sc._jvm.org.apache.spark.ml.classification
    held = sc._gateway.new_array(kind.DecisionTreeClassificationModel, len(trees))
    for t, m in enumerate(trees):
        held[t] = m._java_obj.trees()[0]
    java = kind.RandomForestClassificationModel(estimator.uid, held, trees[0].numFeatures, n_classes)
    return estimator._copyValues(RandomForestClassificationModel(java))


def _cell(names: Sequence[str], splits: Sequence[Sequence[float]]) -> Column:
    """Number of the cell of a row's bins, the last feature's bins next to each other."""
    at = F.lit(0)
    for name, s in zip(names, splits):
        at = at * (len(s) - 1) + F.col(name).cast("int")
    return at


def _by_cells(pipeline: PipelineModel) -> bool:
    """Whether the pipeline is one of :func:`_fit_cells`."""
    first = pipeline.stages[0]
    return isinstance(first, Bucketizer) and first.isSet(first.outputCols) and first.getOutputCols()[0] == "_bin_0"


def _scored_cells(pipeline: PipelineModel, spark: SparkSession) -> DataFrame:
    """``_cell`` and what the model gives for it, one row for each of its at most MAX_CELLS cells."""
    names, splits = pipeline.stages[0].getOutputCols(), pipeline.stages[0].getSplitsArray()
    sizes = [len(s) - 1 for s in splits]
    n, bins = 1, []
    for name, size in reversed(list(zip(names, sizes))):
        bins.append(F.expr(f"CAST(id DIV {n} % {size} AS DOUBLE)").alias(name))
        n *= size
    grid = spark.range(0, n, 1, 1).select(F.col("id").cast("int").alias("_cell"), *bins)
    return PipelineModel(pipeline.stages[1:]).transform(grid)


def fit(
    df: DataFrame, features: Sequence[str], label: str, estimator, kind: str, weight: str | None = None
) -> FittedModel:
    """Train (M6).  Rows with a null label are dropped; ``binary`` requires exactly two
    classes.  Returns a :class:`FittedModel`.  Classifiers by trees over few features learn from
    the rows counted by cell and class (MAX_CELLS), all others from the rows one by one."""
    features = list(features)
    data = df.where(F.col(label).isNotNull())
    assembler = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="skip")
    estimator.setFeaturesCol("_features")
    if hasattr(estimator, "setPredictionCol"):
        estimator.setPredictionCol("_pred")
    # iterative learners scan the input many times: keep only the needed columns, computed once
    needed = list(dict.fromkeys(features + [label] + ([weight] if weight else [])))
    data = data.select(*needed)
    countable = kind != "regression" and _cell_bins(estimator, data, features, 2) > 0
    data = data.persist(StorageLevel.MEMORY_AND_DISK) if countable else _in_tasks(data)
    try:
        if kind == "regression":
            estimator.setLabelCol(label)
            data2 = data.withColumn(label, F.col(label).cast("double"))
            model = Pipeline(stages=[assembler, estimator]).fit(data2)
            return FittedModel(model, features, kind)
        labels, numeric = _label_index(data, label)
        if kind == "binary" and len(labels) != 2:
            raise ValueError(f"binary classification needs exactly 2 label values, found {len(labels)}")
        if countable:
            if bins := _cell_bins(estimator, data, features, len(labels)):
                estimator.setLabelCol("_label_idx")
                return FittedModel(_fit_cells(data, features, label, estimator, labels, numeric, bins), features, kind, labels, numeric)
            data = _in_tasks(data)
        data2 = _encode_label(data, label, labels, numeric)
        estimator.setLabelCol("_label_idx")
        model = Pipeline(stages=[assembler, estimator]).fit(data2)
        return FittedModel(model, features, kind, labels, numeric)
    finally:
        data.unpersist()


def _prob_name(v) -> str:
    return "p_" + re.sub(r"[^0-9A-Za-z_]", "_", str(v))


def prob_names(labels: Sequence) -> list[str]:
    """Probability column per label; labels that clean to one name get _2, _3, ... in label order."""
    seen: dict[str, int] = {}
    out = []
    for v in labels:
        name = _prob_name(v)
        seen[name] = seen.get(name, 0) + 1
        while seen[name] > 1 and f"{name}_{seen[name]}" in out:
            seen[name] += 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out


def _complete(df: DataFrame, features: Sequence[str]) -> Column:
    ok = F.lit(True)
    for c in features:
        x = F.col(c).cast("double")
        ok = ok & x.isNotNull() & ~F.isnan(x)
    return ok


def score(model: FittedModel, df: DataFrame, keep_probability: bool = True) -> DataFrame:
    """Apply a fitted model (M8, M9): input columns + ``prediction`` (decoded to the
    original label) + ``p_<label>`` per class where the model gives probabilities.

    Every input row is kept: where a feature is missing (null or NaN) the prediction and
    the probabilities are null.  Margin models without probabilities (SVM) give ``margin``."""
    feats, stages = list(model.features), model.pipeline.stages
    saved = {c: f"_in_{i}" for i, c in enumerate(feats)}
    drop = {"_features", "_pred", "rawPrediction", "probability", "_ok", *saved.values()}
    filled = df.withColumn("_ok", _complete(df, feats)).withColumns({saved[c]: F.col(c) for c in feats})
    filled = filled.withColumns({c: F.when(F.col("_ok"), F.col(c).cast("double")).otherwise(0.0) for c in feats})
    if _by_cells(model.pipeline):  # the cells are scored once and sent to the rows; an incomplete row has none
        cells = _scored_cells(model.pipeline, df.sparkSession)
        given = _given(model, set(cells.columns), keep_probability)
        cells = cells.select("_cell", *[x.alias(f"_out_{i}") for i, x in enumerate(given.values())])
        names = stages[0].getOutputCols()
        out = stages[0].transform(filled).withColumn("_cell", F.when(F.col("_ok"), _cell(names, stages[0].getSplitsArray())))
        out = out.join(F.broadcast(cells), "_cell", "left")
        new = {name: F.col(f"_out_{i}") for i, name in enumerate(given)}
        drop |= {"_cell", *names, *cells.columns}
    else:
        out = model.pipeline.transform(filled)
        new = {name: F.when(F.col("_ok"), x) for name, x in _given(model, set(out.columns), keep_probability).items()}
    out = out.withColumns({c: F.col(saved[c]) for c in feats}).withColumns(new)
    return out.select(*df.columns, *[c for c in out.columns if c not in df.columns and c not in drop])


def _given(model: FittedModel, columns: set[str], keep_probability: bool) -> dict[str, Column]:
    """The columns that scoring adds, from the ``columns`` of the pipeline's output."""
    if model.kind == "regression":
        return {"prediction": F.col("_pred")}
    lab = F.array(*[F.lit(v) for v in model.labels])
    new = {"prediction": F.element_at(lab, F.col("_pred").cast("int") + 1)}
    if keep_probability and "probability" in columns:
        arr = vector_to_array(F.col("probability"))
        new |= {name: arr[i] for i, name in enumerate(prob_names(model.labels))}
    elif keep_probability and "rawPrediction" in columns and model.kind == "binary":
        new["margin"] = vector_to_array(F.col("rawPrediction"))[1]
    return new


# ------------------------------------------------------------------ clustering

def _feature_array(features: Sequence[str] | str) -> tuple[Column, Column]:
    """The features as one array, and whether none of them is missing."""
    if isinstance(features, str):
        arr = F.col(features).cast("array<double>")
    else:
        arr = F.array(*[F.col(c).cast("double") for c in features])
    return arr, arr.isNotNull() & F.forall(arr, lambda v: v.isNotNull() & ~F.isnan(v))


def with_features(df: DataFrame, features: Sequence[str] | str, out: str = "_features") -> DataFrame:
    """Add a vector column from numeric columns or one array column (JVM-side
    ``array_to_vector``); rows with a missing value are skipped, as VectorAssembler's
    ``handleInvalid="skip"`` does."""
    from pyspark.ml.functions import array_to_vector

    arr, ok = _feature_array(features)
    return df.where(ok).withColumn(out, array_to_vector(arr))


def fit_kmeans(
    df: DataFrame, features: Sequence[str] | str, K: int = 8, init: str = "k-means||", n_init: int = 1,
    max_iter: int = 20, tol: float = 1e-4, seed: int = 42,
) -> FittedModel:
    """K-means (M4, M7).  ``n_init`` independent restarts (different seeds); the fit
    with the lowest training cost is kept.  ``features`` is a list of numeric columns
    or one array column."""
    from pyspark.ml.clustering import KMeans

    init_mode = {"k-means": "k-means||", "k-means++": "k-means||", "k-means||": "k-means||", "random": "random"}[init]
    data = with_features(df, features)
    best = None
    for i in range(max(1, int(n_init))):
        km = KMeans(k=int(K), initMode=init_mode, maxIter=int(max_iter), tol=float(tol), seed=seed + i,
                    featuresCol="_features", predictionCol="prediction")
        m = Pipeline(stages=[km]).fit(data)
        cost = m.stages[-1].summary.trainingCost
        if best is None or cost < best[0]:
            best = (cost, m)
    feats = features if isinstance(features, str) else list(features)
    return FittedModel(best[1], feats, "cluster", extra={"cost": best[0]})


def assign_clusters(model: FittedModel, df: DataFrame) -> DataFrame:
    """Cluster id as ``prediction`` (M10); null where a feature is missing, no row is dropped."""
    from pyspark.ml.functions import array_to_vector

    arr, ok = _feature_array(model.features)
    zeros = F.array(*[F.lit(0.0)] * len(model.pipeline.stages[-1].clusterCenters()[0]))
    ready = df.withColumn("_ok", F.coalesce(ok, F.lit(False))).withColumn("_features", array_to_vector(F.when(F.col("_ok"), arr).otherwise(zeros)))
    out = model.pipeline.transform(ready)
    return out.withColumn("prediction", F.when(F.col("_ok"), F.col("prediction"))).drop("_features", "_ok")


def centres_table(model: FittedModel, spark) -> DataFrame:
    centres = model.pipeline.stages[-1].clusterCenters()
    return spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)], "cluster int, centre array<double>")


def assign_to_centres(df: DataFrame, features: Sequence[str] | str, centres: DataFrame, out: str = "prediction") -> DataFrame:
    """Nearest centre from a centre TABLE ``(cluster, centre array<double>)``.

    The table is a model of k rows: it is broadcast once as a matrix, and every Arrow batch
    takes the first minimum of its squared distances (ties -> smaller cluster id).  Only the
    features are looked into; all other columns, of any type, pass as they are.  A row with a
    missing, NaN or infinite feature, or with another number of features, has no cluster."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql.types import IntegerType, StructField, StructType

    from prepframe._session import ship_package

    spark = df.sparkSession
    ship_package(spark)
    rows = centres.orderBy("cluster").collect()  # k rows, the model
    ids = np.array([int(r["cluster"]) for r in rows], dtype=np.int32)
    dim = len(rows[0]["centre"]) if rows else 0
    model = spark.sparkContext.broadcast((ids, np.array([r["centre"] for r in rows], dtype=np.float64).reshape(len(rows), dim)))
    if isinstance(features, str):
        x = F.col(features).cast("array<double>")
    else:
        x = F.array(*[F.col(c).cast("double") for c in features])
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & (F.size(x) == dim) & F.lit(len(rows) > 0)
    kept = df.drop(out)

    def run(batches):
        cid, m = model.value
        for b in batches:
            held = b.column(b.num_columns - 1)
            ok = held.is_valid().to_numpy(zero_copy_only=False)
            best = np.zeros(b.num_rows, np.int32)
            if ok.any():
                q = held.flatten().to_numpy(zero_copy_only=False).reshape(int(ok.sum()), m.shape[1])
                best[ok] = cid[_nearest(q, m)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(best, pa.int32(), mask=~ok)], names=[*b.schema.names[:-1], out])

    schema = StructType([*kept.schema.fields, StructField(out, IntegerType())])
    return df.select(*(df[c] for c in kept.columns), F.when(usable, x).alias("_features_of_row")).mapInArrow(run, schema)


def _nearest(q, m):
    """Index of the first nearest row of ``m`` for every row of ``q``; about two million distances are held at once."""
    import numpy as np

    part, best = max(1, 2_000_000 // len(m)), []
    for at in range(0, len(q), part):
        rows = q[at : at + part]
        d2 = np.zeros((len(rows), len(m)))
        for j in range(m.shape[1]):  # differences, so that large offsets do not cancel
            d2 += (rows[:, j, None] - m[None, :, j]) ** 2
        best.append(np.argmin(d2, axis=1))
    return np.concatenate(best)


# ------------------------------------------------------------------ evaluation of a model

def positive_class(labels: list, numeric: bool):
    """1 of 0/1 labels, otherwise the less frequent class."""
    if numeric and {float(v) for v in labels} == {0.0, 1.0}:
        return next(v for v in labels if float(v) == 1.0)
    return labels[-1]


def evaluate(model: FittedModel, scored: DataFrame, label: str, pos_label=None) -> DataFrame:
    if model.kind == "regression":
        return E.regression_metrics(scored, label, "prediction")
    if model.kind == "binary":
        pos = pos_label if pos_label is not None else positive_class(model.labels, model.label_numeric)
        name = prob_names(model.labels)[model.labels.index(pos)]
        if name in scored.columns:
            return E.binary_metrics(scored, label, "prediction", pos, score=name)
        if "margin" in scored.columns:  # margin model: AUC by margin, no log-loss
            sign = 1.0 if model.labels.index(pos) == 1 else -1.0
            base = E.binary_metrics(scored, label, "prediction", pos)
            auc = E.binary_auc(scored.withColumn("_m", F.lit(sign) * F.col("margin")), label, "_m", pos).collect()[0][0]  # one row
            return base.withColumn("auc", F.lit(auc).cast("double"))
        return E.binary_metrics(scored, label, "prediction", pos)
    return E.multiclass_metrics(scored, label, "prediction")


# ------------------------------------------------------------------ cross-validation / tuning

POOLS = 4


def _concurrently(spark: SparkSession, jobs: Sequence, parallelism: int) -> list:
    """Results of ``jobs`` in their order, at most ``parallelism`` at a time, each in a scheduler pool of its own.

    Spark shares its executors among the pools (``spark.scheduler.mode`` FAIR) or fills one
    job's idle cores with the next job's tasks (FIFO)."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    def run(numbered):
        i, job = numbered
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fits-{i % parallelism}")
        return job()

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(run), (i, j)) for i, j in enumerate(jobs)]]


def cross_validate(
    df: DataFrame, features: Sequence[str], label: str, make, kind: str, key: str, k: int = 3, seed: int | None = None,
    pos_label=None, parallelism: int = POOLS,
) -> DataFrame:
    """k-fold metrics table (D47): folds by a hash of ``key`` (reproducible, disjoint);
    ``make()`` returns a fresh estimator.  One metric row per fold plus ``fold``.  The
    positive class is ``pos_label``, or chosen once from the whole table.  The folds are
    columns of one persisted projection; their fits are submitted together."""
    from pyspark import StorageLevel

    if kind == "binary" and pos_label is None:
        pos_label = positive_class(*_label_index(df, label))
    names = [features] if isinstance(features, str) else list(features)
    folded = df.select(*dict.fromkeys([*names, label]), (hash_bucket(key, seed) % k).cast("int").alias("_fold"))
    folded = folded.persist(StorageLevel.MEMORY_AND_DISK)

    def one(i: int):
        def job():
            m = fit(folded.where(F.col("_fold") != i), features, label, make(), kind)
            met = evaluate(m, score(m, folded.where(F.col("_fold") == i)), label, pos_label)
            return met.schema, met.withColumn("fold", F.lit(i)).collect()  # one row

        return job

    try:
        got = _concurrently(df.sparkSession, [one(i) for i in range(k)], parallelism)
    finally:
        folded.unpersist()
    schema = StructType([*got[0][0].fields, StructField("fold", IntegerType())])
    return df.sparkSession.createDataFrame([tuple(r) for _, rows in got for r in rows], schema)


def tune(
    df: DataFrame, features: Sequence[str], label: str, kind: str, grid: Sequence[tuple[str, dict]], key: str,
    metric: str, ratio: float = 0.75, seed: int | None = None, higher_is_better: bool = True,
    halving: int | None = None, parallelism: int = POOLS,
):
    """Grid over ``(algo, params)`` pairs - several estimators allowed.

    Train on a hash split, score the rest; returns ``(metrics table, best FittedModel)``, the
    model with ``extra["algo"]`` and ``extra["params"]``.  Both parts are one persisted
    projection and fits are submitted together.  With ``halving`` = e the grid shrinks by
    successive halving: in each rung the best 1/e of the candidates go on to e times the
    training rows (nested hash samples), the last rung trains on all of them; ``rung`` in the
    table is the last one that a candidate reached."""
    import math

    from pyspark import StorageLevel

    if halving is not None and halving < 2:
        raise ValueError("halving must be at least 2")
    spark, grid = df.sparkSession, list(grid)
    names = [features] if isinstance(features, str) else list(features)
    cut = int(ratio * HASH_SPACE)
    kept = df.select(*dict.fromkeys([*names, label]), hash_bucket(key, seed).alias("_h")).persist(StorageLevel.MEMORY_AND_DISK)
    test = kept.where(F.col("_h") >= cut)
    rungs = 1 if halving is None or len(grid) < 2 else math.ceil(math.log(len(grid), halving) - 1e-9)
    alive, last = list(range(len(grid))), {}

    def one(i: int, rows: DataFrame):
        def job():
            algo, params = grid[i]
            m = fit(rows, features, label, make_estimator(kind, algo, **params), kind)
            m.extra |= {"algo": algo, "params": repr(sorted(params.items()))}
            value = evaluate(m, score(m, test), label).select(metric).first()[0]
            return m, None if value is None else float(value)

        return job

    def place(i: int):
        v = last[i][1]
        return (v is None, 0.0 if v is None else -v if higher_is_better else v, i)

    try:
        for rung in range(1, rungs + 1):
            share = 1.0 if rung == rungs else halving ** (rung - rungs)
            rows = kept.where(F.col("_h") < int(cut * share))
            for i, (m, value) in zip(alive, _concurrently(spark, [one(i, rows) for i in alive], parallelism)):
                last[i] = (m, value, rung)
            alive.sort(key=place)
            if rung < rungs:
                alive = alive[: max(1, math.ceil(len(alive) / halving))]
    finally:
        kept.unpersist()
    rows = [(grid[i][0], repr(sorted(grid[i][1].items())), last[i][1], last[i][2]) for i in range(len(grid))]
    table = spark.createDataFrame(rows, f"algo string, params string, {metric} double, rung int")
    best = last[alive[0]] if alive else None
    return table, best[0] if best and best[1] is not None else None


# ------------------------------------------------------------------ recommendation

def frequent_itemsets(df: DataFrame, basket: str, item: str, min_support: float = 0.01, min_confidence: float = 0.5):
    """Frequent itemsets and rules with Spark ML FP-growth (D45; Apriori gives the same
    answer).  Baskets are ``collect_set`` per basket key - bounded by basket size."""
    from pyspark.ml.fpm import FPGrowth

    baskets = df.where(F.col(item).isNotNull()).groupBy(basket).agg(F.collect_set(F.col(item).cast("string")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    return model.freqItemsets, model.associationRules


def fit_als(df: DataFrame, user: str, item: str, rating: str, rank: int = 10, implicit: bool = False,
            reg: float = 0.1, max_iter: int = 10, seed: int = 42):
    """Matrix factorisation (D46); user and item ids must be integers."""
    from pyspark.ml.recommendation import ALS

    als = ALS(userCol=user, itemCol=item, ratingCol=rating, rank=rank, implicitPrefs=implicit, regParam=reg,
              maxIter=max_iter, seed=seed, coldStartStrategy="drop", nonnegative=implicit)
    return als.fit(df)


def recommend(model, n: int, user: str) -> DataFrame:
    """Top-n items per user, one row each: ``(user, rank, item, score)``."""
    recs = model.recommendForAllUsers(n)
    return recs.select(user, F.posexplode("recommendations").alias("pos", "r")).select(
        user, (F.col("pos") + 1).alias("rank"), F.col(f"r.{model.getItemCol()}").alias("item"), F.col("r.rating").alias("score")
    )
