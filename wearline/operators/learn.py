"""Five boosted-tree models over the sensor measures: split, fit, F1, scoring."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.schemas import FAILURES, MEASURES
from wearline.session import pin

LABELS = [f"{f}_label" for f in FAILURES]
# Training settings.
ROUNDS, DEPTH, RATE, SAMPLE, SEED, TEST_PERCENT = 150, 5, 0.08, 0.9, 42, 20
MODEL = ("gbt_multioutput", "v1")
SPLIT_BUCKETS = 1000
# Every level of every tree is a job over the training rows, whose results go to the driver.
ROWS_PER_TASK = 20_000


def split_bucket(key: str, seed: int = SEED, buckets: int = SPLIT_BUCKETS, row: Column | None = None) -> Column:
    """Bucket of a row, fixed by its key and the seed alone; by ``row`` where the key is NULL."""
    text = F.col(key).cast("string")
    if row is not None:
        text = F.coalesce(text, row.cast("string"))
    digest = F.md5(F.concat(text, F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def stratified_split(
    df: DataFrame, stratum: str, key: str, test_percent: int = TEST_PERCENT, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with the same share of test rows in every stratum.

    Rows are hashed to buckets; per stratum the buckets up to a threshold become test
    rows, the threshold (or none at all) being the one whose row count is closest to the
    share. Only the bucket counts are shuffled, and copies of a key stay on one side. Every
    row is in one of the two: NULL is a stratum like any other, and rows without a key are
    hashed whole.
    """
    hashed = df.withColumn("_bucket", split_bucket(key, seed, row=F.xxhash64(*df.columns)))
    counts = hashed.groupBy(stratum, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    part = Window.partitionBy(stratum)
    sums = counts.withColumns(
        {
            "_upto": F.sum("_n").over(part.orderBy("_bucket")),
            "_all": F.sum("_n").over(part),
        }
    )
    distance = F.abs(F.col("_upto") * 100 - F.col("_all") * test_percent)
    last = sums.groupBy(F.col(stratum).alias("_stratum")).agg(
        F.min_by(F.struct(distance.alias("off"), "_bucket"), F.struct(distance, F.col("_bucket"))).alias("_best"),
        (F.max("_all") * test_percent).alias("_off_without"),
    )
    last = last.select(
        "_stratum", F.when(F.col("_best.off") < F.col("_off_without"), F.col("_best._bucket")).otherwise(-1).alias("_last")
    )
    placed = hashed.join(pin(last, "strata"), F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    test = F.coalesce(F.col("_bucket") <= F.col("_last"), F.lit(False))
    return (
        placed.filter(~test).select(*df.columns),
        placed.filter(test).select(*df.columns),
    )


def missing_as_values(measures: Sequence[str] = MEASURES) -> SQLTransformer:
    """Measures for trees: a missing one is -1, below all readings, with a flag of its own.

    Flags are 1 and 2: with many zeros the vectors were sparse, and each look into one a search.
    """
    columns = ", ".join(
        f"coalesce(nanvl(CAST({m} AS DOUBLE), CAST(NULL AS DOUBLE)), -1D) AS _known_{m}, "
        f"1D + CAST({m} IS NULL OR isnan({m}) AS DOUBLE) AS _missing_{m}"
        for m in measures
    )
    return SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")


def assembler(measures: Sequence[str] = MEASURES) -> VectorAssembler:
    columns = [f"_{kind}_{m}" for kind in ("known", "missing") for m in measures]
    return VectorAssembler(inputCols=columns, outputCol="_features", handleInvalid="error")


def training_rows(train: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """The labelled rows in as many tasks as their number asks for, however the input was cut.

    There is no gain in more tasks than run at once, and each one's result goes to the driver.
    """
    rows = pin(train.dropna(subset=[*labels]).select(*MEASURES, *labels), "train")
    spark = rows.sparkSession
    most = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return rows.repartition(max(1, min(most, -(-rows.count() // ROWS_PER_TASK))))


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt out evenly: the trees that each goes through are the work, not its few bytes in a file."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def fit(
    train: DataFrame,
    labels: Sequence[str] = LABELS,
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    rate: float = RATE,
    sample: float = SAMPLE,
    seed: int = SEED,
    parallel: int = 5,
) -> PipelineModel:
    """One boosted-tree model per label, fitted side by side on one cached feature table."""
    vectors = [missing_as_values(), assembler()]
    data = PipelineModel(stages=vectors).transform(training_rows(train, labels)).select("_features", *labels)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)

    def one(label: str):
        trees = GBTClassifier(
            featuresCol="_features",
            labelCol=label,
            predictionCol=f"_class_{label}",
            maxIter=rounds,
            maxDepth=depth,
            stepSize=rate,
            subsamplingRate=sample,
            featureSubsetStrategy=str(sample),
            seed=seed,
        )
        trees.setProbabilityCol(f"_prob_{label}").setRawPredictionCol(f"_raw_{label}")
        return trees.fit(data)

    try:
        with ThreadPool(parallel) as pool:
            models = pool.map(one, labels)
    finally:
        data.unpersist()
    return PipelineModel(stages=[*vectors, *models])


def score(
    model: PipelineModel,
    features: DataFrame,
    run_ts: Column,
    name: tuple[str, str] = MODEL,
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """One prediction per feature row, missing measures or not; the score is the largest
    class-1 probability."""
    scored = model.transform(spread(features))
    chances = [vector_to_array(f"_prob_{label}")[1] for label in labels]
    classes = [
        F.col(f"_class_{label}").cast("int").alias("pred_" + label.removesuffix("_label"))
        for label in labels
    ]
    return scored.select(
        "udi",
        "product_id",
        run_ts.alias("prediction_ts"),
        *classes,
        F.lit(name[0]).alias("model_name"),
        F.lit(name[1]).alias("model_version"),
        F.greatest(F.lit(0.0), *chances).alias("prediction_score"),
        run_ts.alias("_pred_loaded_ts"),
    )


def f1_scores(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """F1 per target from one pass; ``pairs`` maps a target to (label, prediction) columns.

    F1 is 0 where neither labels nor predictions hold a positive.
    """
    counts = []
    for target, (label, predicted) in pairs.items():
        yes, said = F.col(label) == 1, F.col(predicted) == 1
        counts += [
            F.count_if(yes & said).alias(f"{target}_hit"),
            F.count_if(yes).alias(f"{target}_yes"),
            F.count_if(said).alias(f"{target}_said"),
        ]
    rows = []
    for target in pairs:
        hit, total = F.col(f"{target}_hit"), F.col(f"{target}_yes") + F.col(f"{target}_said")
        f1 = F.when(total > 0, 2.0 * hit / total).otherwise(0.0)
        rows.append(F.struct(F.lit(target).alias("target"), f1.alias("f1")))
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def evaluate(model: PipelineModel, test: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """F1 per label of the held-out rows."""
    targets = {label.removesuffix("_label"): (label, f"_class_{label}") for label in labels}
    return f1_scores(model.transform(spread(test)), targets)


def save(model: PipelineModel, path: str) -> None:
    """Persist the models with their column lists."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
