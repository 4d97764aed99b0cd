"""Risk model: feature selection, split, random forest, scoring.

Spark ML end to end: ``StringIndexer`` → ``VectorAssembler`` →
``RandomForestClassifier`` in one ``Pipeline``; the feature list lives in
the assembler, so the saved ``PipelineModel`` carries it (K11).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyhealth.functions.columns import round_half_even, zero_fill
from skyhealth.functions.constants import MODEL_VERSION, PROB_COLUMNS
from skyhealth.schemas import MODEL_FEATURES_BASE, MODEL_FEATURES_OPTIONAL

TARGET = "health_category"

# ---------------------------------------------------------------- fixed values
# Reference model configuration: 200 trees, depth 15, min split 5, seed 42,
# balanced class weights, 20 % stratified hold-out.
NUM_TREES = 200
MAX_DEPTH = 15
MIN_SAMPLES_SPLIT = 5
SEED = 42
TEST_FRACTION = 0.2
# ---------------------------------------------------------- end fixed values


def select_features(df: DataFrame) -> list[str]:
    """M1: base features plus whichever optional ones the table has."""
    return MODEL_FEATURES_BASE + [f for f in MODEL_FEATURES_OPTIONAL if f in df.columns]


def training_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Drop rows with NULL in any feature or the target."""
    return df.dropna(subset=list(features) + [TARGET])


SPLIT_BUCKETS = 1 << 16


def split_hash(keys: Sequence[str], seed: int = SEED) -> Column:
    """Bucket of a row by its key."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(SPLIT_BUCKETS))


def stratified_split(df: DataFrame, keys: Sequence[str] = ("site_id", "date"), test_fraction: float = TEST_FRACTION,
                     seed: int = SEED, label: str = TARGET) -> DataFrame:
    """M2: tag each row train or test so that every class gives exactly
    ``round(test_fraction * n_c)`` rows. Counts per class and hash bucket are
    summed up to the bucket that holds the cut; only that bucket's rows are
    ranked, so no class is sorted."""
    rows = df.withColumn("__h", split_hash(keys, seed))
    counts = rows.groupBy(label, "__h").agg(F.count(F.lit(1)).alias("n"))
    up_to = Window.partitionBy(label).orderBy("__h")
    cuts = (counts.withColumns({"s": F.sum("n").over(up_to),
                                "want": F.round(F.sum("n").over(Window.partitionBy(label)) * F.lit(test_fraction))})
            .where(F.col("s") >= F.col("want")).groupBy(label)
            .agg(F.min(F.struct("__h", (F.col("want") - F.col("s") + F.col("n")).alias("need"))).alias("c"))
            .select(label, F.col("c.__h").alias("__cut"), F.col("c.need").alias("__need")))
    rows = rows.join(cuts, label)
    apart = rows.where(F.col("__h") != F.col("__cut")).withColumn("is_test", F.col("__h") < F.col("__cut"))
    place = F.row_number().over(Window.partitionBy(label, "__h").orderBy(*keys))
    at_cut = rows.where(F.col("__h") == F.col("__cut")).withColumn("is_test", place <= F.col("__need"))
    return apart.unionByName(at_cut).select(*df.columns, "is_test")


def class_weights(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Sklearn "balanced" weights n / (k · n_c) per class.

    The totals are windows over the class-count aggregate, which has one
    row per class (a handful of rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    every = Window.partitionBy()
    return counts.select(label, "n_c", (F.sum("n_c").over(every)
                                         / (F.count(F.lit(1)).over(every) * F.col("n_c"))).alias("weight"))


def with_weights(df: DataFrame, label: str = TARGET) -> DataFrame:
    return df.join(class_weights(df, label).select(label, "weight"), [label], "inner")


#: Spark groups the nodes of a pass by this limit and draws their feature
#: subsets in that order, so another value gives another forest: a constant.
STATS_MEMORY_MB = 1024


def build_pipeline(features: Sequence[str], num_trees: int = NUM_TREES,
                   max_depth: int = MAX_DEPTH) -> Pipeline:
    """M3: the reference forest. ``min_samples_split`` has no Spark
    equivalent; ``minInstancesPerNode = ceil(5 / 2)`` bounds leaves instead."""
    indexer = StringIndexer(inputCol=TARGET, outputCol="label", handleInvalid="keep",
                            stringOrderType="alphabetAsc")
    assembler = VectorAssembler(inputCols=list(features), outputCol="features",
                                handleInvalid="keep")
    rf = RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth,
                                minInstancesPerNode=(MIN_SAMPLES_SPLIT + 1) // 2,
                                featureSubsetStrategy="sqrt", weightCol="weight", seed=SEED,
                                labelCol="label", featuresCol="features",
                                maxMemoryInMB=STATS_MEMORY_MB, cacheNodeIds=True)
    return Pipeline(stages=[indexer, assembler, rf])


def train(gold: DataFrame, num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH):
    """Fit on the 80 % split; returns (model, features, split frame)."""
    features = select_features(gold)
    rows = stratified_split(training_rows(gold, features))
    train_df = with_weights(rows.where(~F.col("is_test")))
    model = build_pipeline(features, num_trees, max_depth).fit(train_df)
    return model, features, rows


def labels_of(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def feature_importance(spark, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """M4: importances zipped with names, largest first (metadata-sized)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(features, imp), key=lambda t: -t[1])
    return spark.createDataFrame(rows, "feature string, importance double")


def score(model: PipelineModel, df: DataFrame, features: Sequence[str],
          run_ts: Column | None = None, model_version: str = MODEL_VERSION) -> DataFrame:
    """M5/M6/M7: zero-fill features (F17), predict, attach label,
    confidence (max probability, 4 dp) and one probability column per class
    (0.0 for a class the model never saw)."""
    prepared = zero_fill(df, features)
    if TARGET not in prepared.columns:       # the indexer stage expects the column
        prepared = prepared.withColumn(TARGET, F.lit(None).cast("string"))
    out = model.transform(prepared)
    labels = labels_of(model)
    probs = vector_to_array(F.col("probability"))
    label_arr = F.array(*[F.lit(x) for x in labels])
    cols = {
        "predicted_category": F.element_at(label_arr, F.col("prediction").cast("int") + 1),
        "confidence": round_half_even(F.array_max(probs), 4),
        "model_version": F.lit(model_version),
    }
    for cat, name in PROB_COLUMNS.items():
        cols[name] = round_half_even(probs[labels.index(cat)], 4) if cat in labels else F.lit(0.0)
    if run_ts is not None:
        cols["predicted_at"] = run_ts
    drop = ["label", "features", "rawPrediction", "probability", "prediction"]
    return out.withColumns(cols).drop(*[c for c in drop if c in out.columns])


def save_model(model: PipelineModel, path: str) -> None:
    """Model + feature list artefact."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
