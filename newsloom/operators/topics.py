"""Topics and projection with MLlib."""

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the topic model.
TOPICS = 10
SEED = 42
COMPONENTS = 3


def assign_topics(
    df: DataFrame,
    vector: str = "embedding",
    k: int = TOPICS,
    seed: int = SEED,
    topic: str = "topic",
    centre: str | None = None,
) -> DataFrame:
    """Add the k-means cluster of each row's vector. Labels are arbitrary numbers below k.

    With `centre` a column of that name holds the centre of the row's cluster.
    """
    digest = F.xxhash64(vector)
    ends = df.agg(F.min(digest).alias("low"), F.max(digest).alias("high")).first()
    if ends["low"] == ends["high"]:
        # MLlib does not cluster rows that are all the same, or none.
        alone = df.withColumn(topic, F.lit(0))
        return alone.withColumn(centre, F.col(vector).cast("array<double>")) if centre else alone
    features = df.withColumn("__features", array_to_vector(F.col(vector)))
    model = KMeans(k=k, seed=seed, featuresCol="__features", predictionCol=topic).fit(
        features.select("__features")
    )
    placed = model.transform(features).drop("__features")
    if centre is None:
        return placed
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    return placed.withColumn(centre, F.get(centres, F.col(topic)))


def project(df: DataFrame, vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """Add the first three principal components as x, y, z. Signs are arbitrary.

    Vectors are centred first, since MLlib's projection does not do it. The driver holds
    one matrix of dimension x dimension, whatever the number of rows. A single row, or rows
    that are all the same, lie at the origin.
    """
    digest = F.xxhash64(vector)
    ends = df.agg(F.min(digest).alias("low"), F.max(digest).alias("high")).first()
    if ends["low"] == ends["high"]:
        return df.withColumns({name: F.lit(0.0) for _, name in zip(range(k), ("x", "y", "z"))})
    features = df.withColumn("__raw", array_to_vector(F.col(vector)))
    pipeline = Pipeline(
        stages=[
            StandardScaler(withMean=True, withStd=False, inputCol="__raw", outputCol="__centred"),
            PCA(k=k, inputCol="__centred", outputCol="__pc"),
        ]
    )
    placed = pipeline.fit(features.select("__raw")).transform(features)
    parts = vector_to_array("__pc")
    named = {name: parts[i] for i, name in zip(range(k), ("x", "y", "z"))}
    return placed.withColumns(named).drop("__raw", "__centred", "__pc")
