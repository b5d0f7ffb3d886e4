"""Feature and classifier pipelines on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

# Fixed shape of the classifier: two hidden layers, 20 passes.
HIDDEN_LAYERS = (128, 64)
EPOCHS = 20


def as_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Categorical columns as text; a missing value is the category ``nan``."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in columns})


def feature_stages(categorical: Sequence[str], numeric: Sequence[str], out: str = "features") -> list:
    """Vocabulary lookup with a slot for unknown values, one-hot columns, one vector.

    The vocabulary is kept on the driver, so this is for columns of few values.
    """
    index = [f"{c}_index" for c in categorical]
    hot = [f"{c}_hot" for c in categorical]
    return [
        StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=hot, dropLast=False),
        VectorAssembler(inputCols=[*hot, *numeric], outputCol=out),
    ]


def fit_features(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> PipelineModel:
    return Pipeline(stages=feature_stages(categorical, numeric)).fit(df)


def vector_entries(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """The non-zero entries of a vector column as rows (keys, position, value)."""
    return df.select(*keys, F.posexplode(vector_to_array(F.col(vector))).alias("position", "value")).filter("value <> 0")


def train_classifier(
    train: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str], seed: int = 1
) -> PipelineModel:
    """Feature stages and a perceptron with two hidden layers.

    Features are scaled to unit variance first: the optimiser works on the whole training
    set at once and would otherwise be led by the columns with the largest numbers.
    """
    features = fit_features(train, categorical, numeric)
    prepared = features.transform(train).select("features", F.col(label).cast("double").alias("label"))
    scaler = StandardScaler(inputCol="features", outputCol="scaled").fit(prepared)
    rows = scaler.transform(prepared).select("scaled", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        width = rows.schema["scaled"].metadata.get("ml_attr", {}).get("num_attrs") or scaler.mean.size
        model = MultilayerPerceptronClassifier(
            featuresCol="scaled", labelCol="label", layers=[width, *HIDDEN_LAYERS, 2], maxIter=EPOCHS, seed=seed
        ).fit(rows)
    finally:
        rows.unpersist()
    return PipelineModel(stages=[features, scaler, model])


def positive_probability(scored: DataFrame, out: str = "p") -> DataFrame:
    return scored.withColumn(out, F.get(vector_to_array(F.col("probability")), F.lit(1)))
