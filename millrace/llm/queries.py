"""The registered queries of the operators, each over its whole table, with oracles where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm import decontaminate, gnat, langid, licenses, mixing, nbsvm, neardup, oneperm, privacy, quality_rules, secrets, spelling, warc
from millrace.llm.oracles import ORACLES  # noqa: F401
from millrace.llm.shared import held_out, table
from millrace.session import stable


def op1_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = quality_rules.apply(docs, table(spark, sf_dir, "labels"), keep=["doc_id", "lang"])
    return out.select("doc_id", *[f"rules.{c}" for c in quality_rules.COUNTS], "rules.base_failed", "rules.kept")


def op2_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~held_out(F.col("doc_id"))))
    out = langid.predict(docs, model, carry=["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score")


def op3_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = nbsvm.fit(docs.select("doc_id", "text"), "quality", labels=table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"))))
    out = nbsvm.predict(docs, model, carry=["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "quality.score", "quality.predicted")


def op4_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id", "source"])


def op5_licenses(spark, sf_dir):
    out = licenses.scan(table(spark, sf_dir, "documents"), carry=["doc_id"], block="run")
    return out.select("doc_id", *[f"license.{c}" for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")])


def op6_private(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = privacy.find(docs, privacy.fit(docs), carry=["doc_id"]).withColumn("spans", F.col("private.spans"))
    rules = F.filter("spans", lambda s: s["rule"])
    kinds = F.transform(rules, lambda s: s["kind"])
    n = [F.size(F.array_remove(F.transform(kinds, lambda x: x == F.lit(k)), False)).cast("long").alias(f"n_{k}") for k in privacy.KINDS]
    return out.select("doc_id", *n, F.sha2(privacy.span_text(rules), 256).alias("base_sha256"), privacy.span_text(F.col("spans")).alias("spans"))


def op7_ngram_join(spark, sf_dir):
    return neardup.link_table(table(spark, sf_dir, "documents"))


def op8_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_secrets(spark, sf_dir):
    out = secrets.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "end", "score", "secret")


def op10_decontamination(spark, sf_dir):
    out = decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return out.select("doc_id", F.explode("leaks.hits").alias("hit")).select("doc_id", "hit.*")


def op11_vector_codes(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    model = gnat.fit(vectors)
    if model is None:
        return spark.createDataFrame([], "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string")
    hexed = F.array_join(F.transform("code.entries", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")
    coded = stable(gnat.encode(vectors, model, carry=["vec_id", "label"]).select("vec_id", "label", hexed.alias("code"), "code.error"))
    sums = stable(coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error")))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", "code", "error", "label_error", F.lit(model.digest()).alias("codebooks_sha256"))


def op12_near_copies(spark, sf_dir):
    return oneperm.near_copies(table(spark, sf_dir, "documents"))


def op13_spelling(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_language, op3_quality, op4_mixing, op5_licenses, op6_private, op7_ngram_join, op8_warc, op9_secrets,
    op10_decontamination, op11_vector_codes, op12_near_copies, op13_spelling, pipeline)}
