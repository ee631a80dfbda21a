"""Approximate search: vectors in lists by nearest centroid, a few lists probed.

The index is a table partitioned by ``list_id`` next to a table of centroids and, once
``calibrate`` has compared it with the exact search, the number of lists to probe.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.vectors import norm, unit_length
from millrace.operators.search import search, search_lists
from millrace.session import stable
from millrace.sinks.files import write_table

SAMPLE = 256
RECALL = 0.9


def build_ivf(
    chunks: DataFrame, path: str, lists: int = 100, iterations: int = 10, seed: int = 7,
    train: DataFrame | None = None, centroids: DataFrame | None = None,
) -> None:
    """Cluster the vectors by direction and write ``<path>/centroids`` and ``<path>/lists``.

    Centroids may be fitted on ``train`` (a part of the data), or given as a small table
    ``centroids(list_id, centroid)``; then a chunk goes to the list of the largest cosine,
    equal ones to the smallest list_id.  Every chunk with a vector other than zero is
    assigned.  ``lists`` is fixed by the caller and does not depend on the data.
    """
    spark = chunks.sparkSession
    if centroids is not None:
        centroids.selectExpr("cast(list_id as int) as list_id", "cast(centroid as array<double>) as centroid").write.mode("overwrite").parquet(f"{path}/centroids")
        centers, ids = _centroids(spark, path)
        usable = chunks.filter(norm(F.col("embedding")) > 0)
        assigned = usable.withColumn("list_id", nearest_lists(F.col("embedding"), centers, ids, 1)[0])
        write_table(assigned, f"{path}/lists", partition_by=["list_id"])
        return

    def features(df: DataFrame) -> DataFrame:
        usable = df.filter(norm(F.col("embedding")) > 0)
        return usable.withColumn("_unit", array_to_vector(unit_length(F.col("embedding"))))

    usable = features(chunks)
    model = KMeans(
        k=lists, maxIter=iterations, seed=seed, featuresCol="_unit", predictionCol="list_id", initSteps=2
    ).fit((features(train) if train is not None else usable).select("_unit"))
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    spark.createDataFrame(centers, "list_id int, centroid array<double>").write.mode("overwrite").parquet(
        f"{path}/centroids"
    )
    # Rebalanced, not hashed, by list: a list that holds a third of all vectors is
    # written by many tasks into many files.
    assigned = model.transform(usable).drop("_unit").withColumn("list_id", F.col("list_id").cast("int"))
    write_table(assigned, f"{path}/lists", partition_by=["list_id"])


def _centroids(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    # As many rows as the index has lists, a number fixed when it was built.
    rows = spark.read.parquet(f"{path}/centroids").orderBy("list_id").collect()
    return np.array([r.centroid for r in rows]), np.array([r.list_id for r in rows])


def nearest_lists(vector: Column, centroids: np.ndarray, ids: np.ndarray, probes: int) -> Column:
    unit = centroids / np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-300)

    @F.pandas_udf("array<int>")
    def pick(vectors: pd.Series) -> pd.Series:
        rows = np.stack(vectors.to_numpy()).astype(np.float64)
        # Rounded like similarities, so that equal centroids tie whatever the order of summation.
        scores = np.round((rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)) @ unit.T, 9)
        order = np.argsort(-scores, axis=1, kind="stable")[:, :probes]
        return pd.Series([ids[row].astype(np.int32) for row in order], dtype=object)

    return pick(vector.cast("array<double>"))


def calibrate(spark: SparkSession, path: str, k: int = 10, requests: DataFrame | None = None, recall: float = RECALL, sample: int = SAMPLE) -> int:
    """The fewest probes whose recall at ``k`` is at least ``recall``, written beside the index.

    Measured against the exact search: for each true neighbour, the place of its list in
    the request's order of lists says how many probes find it.  ``requests(request_id,
    vector)`` should be like those to come and none of those the recall is judged by;
    without them ``sample`` indexed vectors, picked by hash, ask for their neighbours other than
    themselves.  At most ``sample`` requests are used.  The share must hold by two
    standard errors, so a small sample asks for more probes; where none suffices, or
    nothing was asked, all lists are probed.
    """
    centroids, ids = _centroids(spark, path)
    index = spark.read.parquet(f"{path}/lists")
    own = requests is None
    if own:
        requests = index.select(F.col("id").alias("request_id"), F.col("embedding").alias("vector"))
    asked = stable(requests.select("request_id", "vector").orderBy(F.xxhash64("request_id"), "request_id").limit(sample))
    true = search(asked.withColumn("k", F.lit(k + own)), index)
    if own:
        true = true.filter("request_id <> id")
    true = stable(true.select("request_id", "id"))
    order = asked.select("request_id", nearest_lists(F.col("vector"), centroids, ids, len(ids)).alias("order"))
    place = F.array_position("order", F.col("list_id")).cast("int")
    # One row per list at most.
    counts = true.join(index.select("id", "list_id"), "id").join(order, "request_id").groupBy(place.alias("place")).count().collect()
    found = np.zeros(len(ids) + 1)
    for r in counts:
        found[r["place"]] += r["count"]
    probes, n = len(ids), asked.count()
    if found.sum():
        share = np.cumsum(found)[1:] / found.sum()
        sure = share - 2 * np.sqrt(np.maximum(share * (1 - share), 0) / max(n, 1)) >= recall
        probes = int(np.argmax(sure)) + 1 if sure.any() else len(ids)
    spark.createDataFrame([(probes,)], "probes int").write.mode("overwrite").parquet(f"{path}/probes")
    return probes


def ivf_search(spark: SparkSession, requests: DataFrame, path: str, probes: int | None = None) -> DataFrame:
    """As ``search``, over the ``probes`` nearest lists of each request only (default: as calibrated)."""
    centroids, ids = _centroids(spark, path)
    if probes is None:
        probes = spark.read.parquet(f"{path}/probes").first()["probes"]
    probing = requests.withColumn("list_id", F.explode(nearest_lists(F.col("vector"), centroids, ids, probes)))
    # At most as many as the index has lists; lists that nobody asks for are not read.
    needed = [r.list_id for r in probing.select("list_id").distinct().collect()]
    index = spark.read.parquet(f"{path}/lists").filter(F.col("list_id").isin(needed))
    return search_lists(index, probing)
