"""Search, index, embedding and retrieval against brute force on small data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import embed as E, ivf
from millrace.operators.search import search
from millrace.plans import retrieve as R

c = F.col
DIM = 8


def make_chunks(spark, n=600, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.normal(size=DIM)
        if i % 50 == 0:
            v = np.zeros(DIM)
        if i % 50 == 1:
            v = np.ones(DIM)  # many equal similarities
        kind = i % 3
        rows.append((i, f"text {i} {'USA' if i % 4 else 'usa (x)'}", [float(np.float32(x)) for x in v], 2014 + i % 9, None,
                     f"S{i % 5}" if kind == 0 else None, f"H{i % 4}" if kind == 1 else None, f"A{i % 6}" if kind == 2 else None))
    return spark.createDataFrame(rows, schemas.CHUNK), rows


FAMILY = {"socioeconomic": 5, "realestate": 6, "asset": 7}


def brute(rows, request):
    rid, vector, k, family, codes, countries, first, last = request
    q = np.array(vector) / np.linalg.norm(vector)
    hits = []
    for row in rows:
        v = np.array(row[2], dtype=np.float64)
        if not v.any():
            continue
        key = row[FAMILY[family]] if family else "any"
        if key is None or (codes is not None and key not in codes):
            continue
        if countries and not any(t.lower() in row[1].lower() for t in countries):
            continue
        if first is not None and last is not None and not first <= row[3] <= last:
            continue
        hits.append((-round(float(v / np.linalg.norm(v) @ q), 9), row[0]))
    return [(i, -s) for s, i in sorted(hits)[:k]]


def make_requests(spark, n=40):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(n):
        v = np.ones(DIM) if i % 7 == 0 else rng.normal(size=DIM)
        family = [None, "socioeconomic", "realestate", "asset"][i % 4]
        codes = {"socioeconomic": ["S0", "S3"], "realestate": ["H1"], "asset": []}.get(family) if i % 3 == 0 else None
        rows.append((f"r{i}", [float(x) for x in v], [1, 5, 1000][i % 3], family, codes, ["USA (X)"] if i % 5 == 0 else None,
                     2015 if i % 2 else None, 2018 if i % 6 else None))
    ddl = "request_id string, vector array<double>, k int, family string, codes array<string>, countries array<string>, start_year int, end_year int"
    return spark.createDataFrame(rows, ddl), rows


@pytest.mark.parametrize("limit", [4096, 7])
def test_search_equals_brute_force(spark, limit):
    """The second limit forces the blocks used for more requests than can be shipped."""
    chunks, rows = make_chunks(spark)
    requests, asked = make_requests(spark)
    got = {}
    for r in search(requests, chunks.repartition(6), request_limit=limit).collect():
        got.setdefault(r.request_id, {})[r["rank"]] = (r.id, r.similarity)
    for request in asked:
        want = brute(rows, request)
        have = got.get(request[0], {})
        assert [have[i + 1][0] for i in range(len(have))] == [i for i, _ in want], request[0]
        assert [s for _, s in sorted((k, v[1]) for k, v in have.items())] == pytest.approx([s for _, s in want])


def test_many_requests_are_one_scan_a_block(spark):
    chunks, rows = make_chunks(spark, 300)
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(5000, DIM))
    requests = spark.createDataFrame([(i, [float(x) for x in v], 4) for i, v in enumerate(vectors)], "request_id int, vector array<double>, k int")
    found = search(requests, chunks)
    assert "CoGroup" not in found._jdf.queryExecution().toString()
    got = {}
    for r in found.collect():
        got.setdefault(r.request_id, []).append((r["rank"], r.id))
    usable = [r for r in rows if any(r[2])]
    unit = np.array([r[2] for r in usable])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    scores = np.round(vectors / np.linalg.norm(vectors, axis=1, keepdims=True) @ unit.T, 9)
    ids = np.array([r[0] for r in usable])
    for i in range(5000):
        assert [x for _, x in sorted(got[i])] == list(ids[np.lexsort((ids, -scores[i]))[:4]])


def test_zero_request_and_empty_table(spark):
    chunks, _ = make_chunks(spark, 60)
    zero = spark.createDataFrame([("z", [0.0] * DIM, 5)], "request_id string, vector array<double>, k int")
    assert search(zero, chunks).count() == 0
    one = spark.createDataFrame([("o", [1.0] * DIM, 5)], "request_id string, vector array<double>, k int")
    assert search(one, chunks.limit(0)).count() == 0
    assert search(one.limit(0), chunks).count() == 0


def test_index_recall_and_completeness(spark, tmp_path):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(20, DIM)) * 4
    rows = [(i, f"t{i}", [float(x) for x in centers[i % 20] + rng.normal(size=DIM)], 2014, None, "S", None, None) for i in range(2000)]
    chunks = spark.createDataFrame(rows, schemas.CHUNK)
    ivf.build_ivf(chunks, str(tmp_path), lists=20, iterations=5)
    assert spark.read.parquet(f"{tmp_path}/lists").count() == 2000
    requests = spark.createDataFrame([(i, rows[i * 13][2], 10) for i in range(40)], "request_id int, vector array<double>, k int")
    exact = {(r.request_id, r.id) for r in search(requests, chunks).collect()}
    near = {(r.request_id, r.id) for r in ivf.ivf_search(spark, requests, str(tmp_path), probes=4).collect()}
    every = {(r.request_id, r.id) for r in ivf.ivf_search(spark, requests, str(tmp_path), probes=20).collect()}
    assert every == exact
    assert len(near & exact) / len(exact) >= 0.9


def test_probes_are_chosen_by_recall(spark, tmp_path):
    """Vectors without clusters: few probes lose neighbours, so calibration must ask for many."""
    rng = np.random.default_rng(9)
    rows = [(i, f"t{i}", [float(x) for x in rng.normal(size=DIM)], 2014, None, "S", None, None) for i in range(3000)]
    chunks = spark.createDataFrame(rows, schemas.CHUNK)
    ivf.build_ivf(chunks, str(tmp_path), lists=30, iterations=5, train=chunks.filter("id < 1000"))
    asked = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=DIM)], 10) for i in range(120)], "request_id int, vector array<double>, k int")
    recall = lambda **o: len({(r.request_id, r.id) for r in ivf.ivf_search(spark, asked, str(tmp_path), **o).collect()} & exact) / len(exact)
    exact = {(r.request_id, r.id) for r in search(asked, chunks).collect()}
    probes = ivf.calibrate(spark, str(tmp_path), 10)
    assert recall(probes=1) < 0.9 <= recall() and 1 < probes < 30
    assert recall(probes=probes) == recall()
    assert ivf.calibrate(spark, str(tmp_path), 10, requests=asked.limit(0)) == 30


def test_embedding(spark):
    texts = ["Gold rose", "gold ROSE!", "silver fell and gold rose", "", None, "..."] * 90
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    rows = E.embed(df).orderBy("id").collect()
    vectors = [np.array(r.embedding) for r in rows]
    assert {len(v) for v in vectors} == {64}
    assert np.array_equal(vectors[0], vectors[1]) and not np.array_equal(vectors[0], vectors[2])
    for r, v in zip(rows, vectors):
        assert np.linalg.norm(v) == pytest.approx(1.0 if r.text and "o" in r.text else 0.0, abs=1e-6)


def test_embedder_sees_bounded_batches(spark):
    def count(texts):
        return np.full((len(texts), 2), float(len(texts)))

    df = spark.range(0, 1001, numPartitions=1).select("id", c("id").cast("string").alias("text"))
    sizes = [r.embedding[0] for r in E.embed(df, embedder=count, batch=200).collect()]
    assert max(sizes) <= 200 and len(sizes) == 1001


def questions(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "question_id int, text string")


def test_questions_are_tagged(spark):
    q = questions(
        spark, "What was USA's GDP trend from 2014-2020 and how did Bitcoin behave in the same years?",
        "Compare Apple stock performance to Ethereum in 2020", "What was the average list price of houses in Ohio in 2019?",
        "Rents before the pandemic versus rents during covid", "Hello?",
    )
    rows = {r.question_id: r for r in R.analyse_questions(q).collect()}
    assert rows[0].data_types == ["socioeconomic", "asset"] and (rows[0].start_year, rows[0].end_year) == (2014, 2020)
    assert rows[0].assets == ["BTC/USD"] and len(rows[0].indicator_codes) == 10 and len(rows[0].sub_queries) == 2
    assert rows[1].assets == ["AAPL", "ETH/USD"] and rows[1].data_types == ["asset"]
    assert rows[2].housing_codes == ["LRAW"] and rows[2].start_year == 2019
    assert (rows[3].start_year, rows[3].end_year) == (2017, 2019) and rows[3].housing_codes == ["RSNA", "RSSA"]
    assert rows[4].data_types == R.CATEGORIES and rows[4].start_year is None


def test_stored_assets_are_tagged(spark):
    q = questions(
        spark, "How did AVGO and BRK.B do in 2020?", "Compare apple, V. and AVGO with inflation", "Tell us about home prices",
        "How did the US do? I see v rising", "Prices in US",
    )
    chunks = spark.createDataFrame([(k,) for k in ("AVGO", "BRK.B", "V", "AAPL", "I", None, "AVGO")], "asset_key string")
    rows = {r.question_id: r for r in R.tag_stored_assets(R.analyse_questions(q), chunks).collect()}
    assert rows[0].assets == ["AVGO", "BRK.B"] and rows[0].data_types == ["asset"] and rows[0].start_year == 2020
    assert rows[1].assets == ["AAPL", "V", "AVGO"] and rows[1].data_types == ["socioeconomic", "asset"]
    assert rows[2].countries == [] and rows[2].assets == []
    assert rows[3].countries == ["USA"] and rows[3].assets == [] and rows[3].data_types == R.CATEGORIES
    assert rows[4].countries == ["USA"]


def test_names_that_no_list_knows(spark):
    q = questions(
        spark, "How did the stock of Berkshire Hathaway do against Apple Inc. in Ohio?", "Is Bank of Nowhere traded? And Berkshire Hathaway shares?",
        "Tell me about Berkshire Hathaway", "Which shares rose in May 2020?", None,
    )
    spans = [r[0] for r in q.orderBy("question_id").select(R.name_spans(c("text"))).collect()]
    assert spans == [["Berkshire Hathaway"], ["Bank of Nowhere", "Berkshire Hathaway"], ["Berkshire Hathaway"], [], None]
    told = [(1, "stock price of berkshire hathaway", 2020, None, None, None, "BRK.B"), (2, "weather report of the week", 2020, None, None, None, "RAIN")]
    ddl = "id int, text string, year_key int, region_key int, socio_indicator_key string, realestate_indicator_key string, asset_key string"
    chunks = E.embed(spark.createDataFrame(told, ddl))
    rows = {r.question_id: r for r in R.resolve_names(R.analyse_questions(q), chunks).collect()}
    assert rows[0].assets == ["AAPL", "BRK.B"] and rows[0].data_types == ["asset"]
    assert rows[1].assets == ["Bank of Nowhere", "BRK.B"] and rows[1].data_types == ["asset"]
    assert rows[2].assets == [] and rows[2].data_types == R.CATEGORIES and rows[3].assets == []
    assert R.resolve_names(R.analyse_questions(q), chunks.limit(0)).filter("question_id = 0").first().assets == ["AAPL", "Berkshire Hathaway"]


def test_state_codes(spark):
    q = questions(
        spark, "price in Ohio in 2019", "price in Ohio (OH)", "West Virginia and Ohio", "Arkansas homes", "Kansas", "nothing",
        "In NEW YORK now", None,
    )
    got = [r[0] for r in q.orderBy("question_id").select(R.add_state_code(c("text"))).collect()]
    assert got == [
        "price in Ohio (OH) in 2019", "price in Ohio (OH)", "West Virginia (WV) and Ohio", "Arkansas (AR) homes", "Kansas (KS)",
        "nothing", "In NEW YORK (NY) now", None,
    ]


def test_rerank_boosts_order_only(spark):
    q = questions(spark, "average rent", "rent")
    hits = spark.createDataFrame([
        (0, "realestate", 1, 1, 0.70, "Annual Real Estate Summary"), (0, "socioeconomic", 1, 2, 0.74, "annual real estate summary"),
        (0, "realestate", 2, 3, 0.60, None), (1, "realestate", 1, 4, 0.70, "annual real estate summary"), (1, "asset", 1, 5, 0.70, "x"),
    ], "question_id int, category string, position int, id int, similarity double, text string")
    got = {}
    for r in R.rerank(q, hits, 2).orderBy("question_id", "rank").collect():
        got.setdefault(r.question_id, []).append((r.id, r.similarity))
    assert got == {0: [(1, 0.70), (2, 0.74)], 1: [(5, 0.70), (4, 0.70)]}


def test_worker_code_runs_without_the_package(tmp_path):
    """Executors unpickle tasks in a place where the package is not installed."""
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", "import pickle, sys; print(pickle.loads(sys.stdin.buffer.read())(['a b']).shape)"],
        input=cloudpickle.dumps(E.HashingEmbedder()), capture_output=True, cwd=tmp_path, env=env, check=True,
    )
    assert done.stdout.strip() == b"(1, 64)"
