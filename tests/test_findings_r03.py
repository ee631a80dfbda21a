"""What the findings of the third round asked for."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window as W, functions as F

from millrace import lookups
from millrace.functions.hashing import leading_bits
from millrace.functions.vectors import unit_length
from millrace.operators import embed as E, ivf, search as S
from millrace.operators.keys import dense_key
from millrace.plans import documents as D, retrieve as R
from registry.fixtures import Data

c = F.col


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Joins that Spark does not broadcast by itself: as over tables too large for it."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _marked(text, states):
    if text is None:
        return None
    padded = " " + "".join(x if "a" <= x <= "z" else " " for x in text.lower()) + " "
    there = sorted((padded.index(f" {n.lower()} "), -len(n), code) for n, code in states if f" {n.lower()} " in padded)
    if not there or f" {there[0][2].lower()} " in padded:
        return text
    end = there[0][0] - there[0][1]
    return f"{text[:end]} ({there[0][2]}){text[end:]}"


def test_state_codes_read_a_text_once_for_all_states(spark):
    states = lookups.pairs(lookups.STATES)
    texts = [None, "", "Ohio", "ohio-Texas", "WEST VIRGINIA/virginia", "Arkansas, Kansas (KS)", "Kansas and AR", "New  York", "New\nYork!", "x.Ohio(OH)", "Ohioan Texas"]
    texts += [f"{a} of {b} in {code}" for (a, _), (b, code) in zip(states, states[7:])]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    out = df.select("i", R.add_state_code(c("text")).alias("text"))
    assert [r["text"] for r in out.orderBy("i").collect()] == [_marked(t, states) for t in texts]
    # A test of each state against the text would make the text ready for each anew.
    assert "filter(" not in plan_of(out) and plan_of(out).count("regexp_replace(") == 1


def test_changes_of_a_corpus_move_no_text(spark, no_broadcast):
    rows = lambda ids: spark.createDataFrame([(str(i), f"text {i}") for i in ids], "content_id string, text string")
    changed = D.corpus_changes(rows([1, 1, 2, 3, 3]), rows([2, 4, 4, 5]))
    assert sorted(map(tuple, changed.collect())) == [("1", "text 1", "removed"), ("3", "text 3", "removed"), ("4", "text 4", "added"), ("5", "text 5", "added")]
    plan = plan_of(changed)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_stored_documents_are_known_by_their_keys(spark, tmp_path):
    docs = lambda ids, text: spark.createDataFrame([(str(i),) for i in ids], "content_id string").withColumn("text", text)
    path = str(tmp_path / "chunks")
    told = F.concat(F.lit("text "), "content_id")
    assert E.store_chunks(docs([1, 2, 2], told), path) == 2
    # The text of a stored document is not made again.
    read = F.when(c("content_id").isin("1", "2"), F.raise_error(F.lit("read again")).cast("string")).otherwise(told)
    assert E.store_chunks(docs([1, 2, 3, 3], read), path) == 1
    assert E.store_chunks(docs([1, 2], read), path) == 0
    assert sorted(r["text"] for r in spark.read.parquet(path).collect()) == ["text 1", "text 2", "text 3"]


def test_stored_documents_beyond_the_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(E, "BROADCAST_ROWS", 1)
    docs = lambda n: spark.range(n).select(c("id").cast("string").alias("content_id"), F.md5(c("id").cast("string")).alias("text"))
    path = str(tmp_path / "chunks")
    assert [E.store_chunks(docs(n), path) for n in (3, 9, 9)] == [3, 6, 0]
    assert spark.read.parquet(path).select("content_id").distinct().count() == 9


def test_chunks_move_their_text_once(spark, tmp_path, no_broadcast):
    spark.createDataFrame([(i, f"t{i}") for i in (-405, -7, 3, 7, 199, 200, 407, 10**6 + 5)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    vectors = [(i, [float(i), 1.0]) for i in (-7, -5, 3, 3, 5, 7, 199, 0, 407, 250)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    chunks = Data(spark, str(tmp_path)).fx_chunks
    # Vectors of the same number by one shuffled join; those of the remainder come to the texts.
    assert plan_of(chunks).count("SortMergeJoin") == 1
    got = sorted((r["id"], r["embedding"][0]) for r in chunks.collect())
    # A number that two vectors have gives its chunk for each of them, in both joins.
    assert got == [(-405, -5.0), (-7, -7.0), (3, 3.0), (3, 3.0), (3, 3.0), (3, 3.0), (7, 7.0), (199, 199.0), (200, 0.0), (407, 407.0), (10**6 + 5, 5.0)]


def test_lengths_are_summed_once_a_vector(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,), ([],)], "v array<float>")
    out = df.select(unit_length(c("v")).alias("u"))
    assert [r["u"] for r in out.collect()] == [[0.6, 0.8], None, None, None]
    assert plan_of(out).count("aggregate(") == 1


def test_index_search_shuffles_vectors_once(spark, tmp_path, no_broadcast):
    rows = [(i, [float(i % 7 + 1), float(i % 3), 1.0], 2000, None, None, None) for i in range(60)]
    chunks = spark.createDataFrame(rows, "id long, embedding array<float>, year_key int, socio_indicator_key string, asset_key string, realestate_indicator_key string")
    ivf.build_ivf(chunks, str(tmp_path), lists=3, iterations=2)
    asked = chunks.filter("id < 5").select(c("id").alias("request_id"), c("embedding").alias("vector"), F.lit(4).alias("k"))
    found = ivf.ivf_search(spark, asked, str(tmp_path), probes=3)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, S.search(asked, chunks).collect()))
    assert "SortMergeJoin" not in plan_of(found)


def test_scores_below_the_best_cost_no_step(monkeypatch):
    asked = pa.table({
        "request_id": [1, 2, 3], "k": [2, 0, 2], "vector": [[1.0, 0.0], [1.0, 0.0], [0.0, 0.0]],
        **{x: pa.array([None] * 3, t) for x, t in (("family", pa.string()), ("codes", pa.list_(pa.string())), ("countries", pa.list_(pa.string())),
                                                   ("start_year", pa.int32()), ("end_year", pa.int32()), ("lists", pa.list_(pa.int32())))}})
    scorer, steps, keep = S._Scorer(asked), [], S._Scorer._keep
    monkeypatch.setattr(S._Scorer, "_keep", lambda self, row, *rest: (steps.append(row), keep(self, row, *rest)))
    batch = lambda ids, vectors: pa.RecordBatch.from_arrays([pa.array(ids), pa.array(vectors)], names=["id", "embedding"])
    scorer.add(batch([5, 6], [[1.0, 0.0], [2.0, 0.0]]))
    scorer.add(batch([7, 8], [[1.0, 1.0], [0.0, 1.0]]))
    assert steps == [0]
    scorer.add(batch([4, 9], [[1.0, 0.0], [np.nan, 1.0]]))  # as near, with a smaller id
    assert scorer.best[0][1].tolist() == [4, 5] and len(scorer.best[1][0]) == len(scorer.best[2][0]) == 0


@pytest.mark.parametrize("train", [False, True])
def test_index_leaves_out_vectors_without_direction(spark, tmp_path, train):
    vectors = [[1.0, 2.0], [2.0, 1.0], [0.0, 0.0], None, [1.0, None], [5.0, 1.0], [-1.0, 0.0]]
    rows = [(i, v, 2000, None, None, None) for i, v in enumerate(vectors)]
    chunks = spark.createDataFrame(rows, "id long, embedding array<float>, year_key int, socio_indicator_key string, asset_key string, realestate_indicator_key string")
    ivf.build_ivf(chunks, str(tmp_path), lists=2, iterations=2, train=chunks if train else None)
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/lists").collect()) == [0, 1, 5, 6]


# the clean and star tables behind a published table.

@pytest.fixture
def folder(spark, tmp_path):
    """Small tables with null keys and rows that come twice."""
    day = "timestamp_seconds(820454400 + 86400 * id)"  # 1996-01-01 and later
    rows = spark.range
    tables = {
        "region": rows(1).selectExpr("cast(id as int) r_regionkey", "'R' r_name"),
        "nation": rows(3).selectExpr("cast(id as int) n_nationkey", "concat('NATION_', id) n_name", "0 n_regionkey"),
        "customer": rows(40).selectExpr("id c_custkey", "concat('C', id) c_name", "cast(id % 3 as int) c_nationkey", "1.0D c_acctbal", "'M' c_mktsegment"),
        "part": rows(12).selectExpr("id p_partkey", "'P' p_name", "'B' p_brand", "element_at(array('ECONOMY', 'SMALL', 'LARGE'), cast(id % 3 + 1 as int)) p_type", "1 p_size", "1.0D p_retailprice"),
        "orders": rows(400).selectExpr(
            "id o_orderkey", "if(id % 50 = 7, null, id % 40) o_custkey", "'O' o_orderstatus", "cast(id % 90 as double) + 0.25D o_totalprice", f"{day} o_orderdate",
            "element_at(array('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'), cast(id % 5 + 1 as int)) o_orderpriority"),
        "lineitem": rows(600).selectExpr(
            "id % 400 l_orderkey", "id % 12 l_partkey", "0L l_suppkey", "cast(id % 7 as int) l_linenumber", "cast(id % 9 as double) l_quantity",
            "cast(id % 70 as double) l_extendedprice", f"{day} l_shipdate"),
    }
    for name, df in tables.items():
        twice = df.unionByName(df.limit(3)) if name in ("orders", "lineitem") else df
        twice.coalesce(1).write.parquet(f"{tmp_path}/tables/{name}.parquet")
    return f"{tmp_path}/tables"


def test_clean_tables_compute_the_yearly_figures_once(spark, folder, monkeypatch):
    from registry import lake

    plans, write = {}, lake.write_table
    monkeypatch.setattr(lake, "write_table", lambda df, path, **rest: (plans.__setitem__(path.rsplit("/", 1)[1], plan_of(df)), write(df, path, **rest)))
    s = lake.silver(Data(spark, folder))
    # The orders are read once, by what is written for all; the old plans summed them up again for each branch.
    assert set(plans) == {"indicators", "meta", "housing", "bars"}
    assert not any("o_custkey" in plans[name] for name in ("indicators", "meta"))
    lazy = lake.clean_tables(Data(spark, folder))
    for name, df in lazy.items():
        cols = df.columns
        assert sorted(map(str, s[name].select(cols).collect())) == sorted(map(str, df.collect())), name


def test_housing_figures_are_not_dealt_by_indicator(spark, folder, no_broadcast):
    from registry import lake

    plan = plan_of(lake.clean_tables(Data(spark, folder))["housing"])
    assert "hashpartitioning(indicator_id" not in plan


def test_dimensions_are_written_once_and_equal_the_plain_ones(spark, folder, monkeypatch):
    from registry import lake

    copied, write = [], lake.write_table
    monkeypatch.setattr(lake, "write_table", lambda df, path, **rest: (copied.append(path.rsplit("/", 1)[1]), write(df, path, **rest)))
    d = Data(spark, folder)
    s, g = lake.silver(d), lake.gold(d)
    assert sorted(copied) == ["bars", "fact_value", "housing", "indicators", "meta"] and len(g) == 9
    pairs = {(r.value, r.unit) for r in g["dim_value"].collect()}
    numbered = g["dim_value"].withColumn("h", F.md5(F.concat_ws("||", c("value").cast("string"), "unit"))).orderBy("h").collect()
    assert [r.value_key for r in numbered] == list(range(1, len(pairs) + 1)) and len(pairs) > 80
    assert g["dim_region"].count() == s["housing"].select("region_id").distinct().count() == 32
    assert g["fact_value"].filter("value_key is null and cryptostock_value_key is null").count() == 0


def test_keys_by_leading_bits_follow_the_digests(spark):
    df = spark.range(20000).select(F.unhex(F.md5(c("id").cast("string"))).alias("h"), "id").repartition(5)
    keyed = dense_key(df, ["h"], "key", spread=leading_bits(c("h")), unneeded=("h",))
    assert keyed.columns == ["key", "id"]
    want = df.select("id", F.row_number().over(W.orderBy(F.hex("h"))).alias("want"))
    assert keyed.join(want, "id").filter("key = want").count() == 20000
    assert dense_key(df.limit(0), ["h"], "key", spread=leading_bits(c("h"))).count() == 0
    # No bounds of ranges are sampled, which would compute the rows twice.
    assert "rangepartitioning" not in plan_of(keyed)


def test_jobs_side_by_side_keep_scratch_folder_and_errors(spark, tmp_path):
    from millrace import session

    with session.scratch(spark) as path:
        got = session.side_by_side(spark, {n: lambda n=n: (session.scratch_path(spark, n), spark.range(n.count("a")).count()) for n in ("a", "aa", "aaa")})
    assert [got[n][1] for n in ("a", "aa", "aaa")] == [1, 2, 3] and all(p.startswith(path) for p, _ in got.values())
    with pytest.raises(ValueError):
        session.side_by_side(spark, {"bad": lambda: int("x"), "good": lambda: 1})
