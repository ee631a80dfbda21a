"""What the findings of the fourth round asked for."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import embed as E, search as S
from millrace.plans import retrieve as R

c = F.col
FILTERS = {"family": pa.string(), "codes": pa.list_(pa.string()), "countries": pa.list_(pa.string()), "start_year": pa.int32(), "end_year": pa.int32(), "lists": pa.list_(pa.int32())}


def asked_table(vectors, k):
    n = len(vectors)
    return pa.table({"request_id": list(range(n)), "k": k, "vector": vectors.tolist(), **{x: pa.array([None] * n, t) for x, t in FILTERS.items()}})


def batches(ids, vectors, size):
    for i in range(0, len(ids), size):
        yield pa.RecordBatch.from_arrays([pa.array(ids[i:i + size]), pa.array(vectors[i:i + size].tolist())], names=["id", "embedding"])


def brute(vectors, k, ids, chunks):
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    scores = np.round(unit(vectors) @ unit(chunks).T, 9)
    return [list(ids[np.lexsort((ids, -row))[:n]]) for row, n in zip(scores, k)]


@pytest.mark.parametrize("kind", ["spread", "equal", "close"])
def test_best_of_single_precision_are_those_of_double(monkeypatch, kind):
    rng = np.random.default_rng(4)
    vectors, n = rng.normal(size=(700, 16)), 3000
    if kind == "equal":  # seven directions, so most scores are shared by hundreds of chunks
        chunks = rng.normal(size=(7, 16))[rng.integers(0, 7, n)] * rng.choice([1.0, 2.0, 4.0], size=(n, 1))
    elif kind == "close":  # scores that differ in the eighth place, which single precision does not hold
        chunks = np.ones((n, 16)) + rng.normal(size=(n, 16)) * 1e-7
        vectors = np.ones((700, 16)) + rng.normal(size=(700, 16)) * 0.3
    else:
        chunks = rng.normal(size=(n, 16))
    ids, k = rng.permutation(n) - 1000, rng.choice([1, 10, 40], size=700).tolist()
    scorer, steps, keep = S._Scorer(asked_table(vectors, k)), [], S._Scorer._keep
    monkeypatch.setattr(S._Scorer, "_keep", lambda self, *rest: (steps.append(1), keep(self, *rest)))
    for batch in batches(ids, chunks, 1000):
        scorer.add(batch)
    want = brute(vectors, k, ids, chunks)
    found = scorer.result(pa.schema([("request_id", pa.int64()), ("id", pa.int64()), ("similarity", pa.float64()), ("k", pa.int32())]))
    assert found.num_rows == sum(k) and found.column("k").to_pylist() == [k[i] for i in found.column("request_id").to_pylist()]
    assert [list(i) for _, i in scorer.best] == want
    # Steps are taken for many requests together: before, each request took one with each batch that has something for it.
    assert len(steps) < 100


def test_requests_beyond_the_limit_read_the_chunks_few_times(spark, monkeypatch):
    rng = np.random.default_rng(8)
    vectors, chunks = rng.normal(size=(300, 8)), rng.normal(size=(500, 8))
    rows = [(i, f"t{i}", [float(np.float32(x)) for x in v], 2014, None, "S", None, None) for i, v in enumerate(chunks)]
    table = spark.createDataFrame(rows, schemas.CHUNK).repartition(3)
    requests = spark.createDataFrame([(f"r{i}", [float(x) for x in v], 1 + i % 5) for i, v in enumerate(vectors)], "request_id string, vector array<double>, k int")
    scans, scan = [], S._scan
    monkeypatch.setattr(S, "_scan", lambda *a: (scans.append(a[1].num_rows), scan(*a))[1])
    found = S.search(requests, table, request_limit=20).collect()
    # 30 scans before, of ten requests each on average.
    assert len(scans) == 2 and sum(scans) == 300
    got = {}
    for r in found:
        got.setdefault(r.request_id, {})[r["rank"]] = r.id
    want = brute(vectors, [1 + i % 5 for i in range(300)], np.arange(500), chunks.astype(np.float32).astype(np.float64))
    assert [[x for _, x in sorted(got[f"r{i}"].items())] for i in range(300)] == want


def test_deep_requests_are_more_blocks(spark, monkeypatch):
    """What the requests of a block may find is bounded, not only what they hold."""
    monkeypatch.setattr(S, "REQUEST_BYTES", 40_000)
    scans, scan = [], S._scan
    monkeypatch.setattr(S, "_scan", lambda *a: (scans.append(a[1].num_rows), scan(*a))[1])
    chunks = spark.createDataFrame([(i, "t", [1.0, float(i)], 2014, None, "S", None, None) for i in range(50)], schemas.CHUNK)
    requests = spark.range(60).select(c("id").alias("request_id"), F.array(F.lit(1.0), c("id").cast("double")).alias("vector"), F.lit(500).alias("k"))
    assert S.search(requests, chunks, request_limit=30).count() == 60 * 50
    assert sum(scans) == 60 and max(scans) < 20


def test_no_request_reads_no_chunk(spark):
    chunks = spark.createDataFrame([(1, "t", [1.0, 2.0], 2014, None, "S", None, None)], schemas.CHUNK)
    unread = chunks.withColumn("embedding", F.when(c("id") > 0, F.raise_error(F.lit("read")).cast("array<float>")).otherwise(c("embedding")))
    none = spark.createDataFrame([], "request_id long, vector array<double>, k int")
    found = S.search(none, unread)
    assert found.count() == 0 and dict(found.dtypes) == dict(S.search(none, chunks).dtypes)


def test_questions_of_one_file_are_embedded_by_many_tasks(spark, tmp_path, monkeypatch):
    spark.range(50).selectExpr("id as question_id", "concat('What was the average list price of homes in Ohio in ', 1996 + id % 4, '?') as text").coalesce(1).write.parquet(f"{tmp_path}/asked")
    told = [(i, f"Housing in Ohio {1996 + i % 4}: list price {i}", 1996 + i % 4, None, None, "LRAW", None) for i in range(80)]
    chunks = E.embed(spark.createDataFrame(told, "id long, text string, year_key int, region_key int, socio_indicator_key string, realestate_indicator_key string, asset_key string"))
    parts, embed = [], R.embed
    monkeypatch.setattr(R, "embed", lambda df, *a: (parts.append(df.rdd.getNumPartitions()), embed(df, *a))[1])
    answers = R.answer_contexts(spark.read.parquet(f"{tmp_path}/asked"), chunks, total_k=40, final_k=5).collect()
    assert len(answers) == 50 and all(r.docs == 5 and f"year {1996 + r.question_id % 4}" in r.context for r in answers)
    assert parts[-1] == int(spark.conf.get("spark.sql.shuffle.partitions"))
