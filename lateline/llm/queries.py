"""One query for each operator over its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lateline.llm import (collocations, exact_dedup, language_id, line_dedup, lm_score, mixing, ngram_join, packing,
                          quality_fm, simhash_join, token_files, vector_search, whitening)
from lateline.llm.registry import QUERIES, SQL, query  # noqa: F401
from lateline.llm.shipping import ship
from lateline.session import shared_folder


def _table(spark, folder, name):
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op2_exact_dedup", exact_dedup.EXACT_SQL)
def op2(spark, folder):
    return exact_dedup.exact_duplicates(_table(spark, folder, "documents"))


@query("op3_source_mix", mixing.MIX_SQL)
def op3(spark, folder):
    return mixing.mix(_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op4_token_files")
def op4(spark, folder):
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write_token_files(_table(spark, folder, "documents"), path, _tokenizer(), end_id=2)
    return token_files.read_token_digests(spark, path)


@query("op6_best_fit_packing")
def op6(spark, folder):
    return packing.packed_documents(_table(spark, folder, "documents"), _tokenizer(), end_id=0, capacity=2048)


@query("op1_language_id")
def op1(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    apart = language_id.held_out(F.col("doc_id"))
    learned = docs.filter(~apart & F.col("doc_id").isNotNull())
    model = language_id.learn(learned)
    rows = docs.select("doc_id", "text", apart.alias("held_out"))
    return language_id.identify(rows, model).select("doc_id", "held_out", "lang_pred", "score", "margin", "accepted")


@query("op10_quality_fm")
def op10(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text", "n_chars")
    apart = language_id.held_out(F.col("doc_id"))
    labels = _table(spark, folder, "labels").filter(~apart)
    machine = quality_fm.learn(docs, labels)
    rated = quality_fm.score(docs.withColumn("held_out", apart), machine, ["doc_id", "held_out"])
    return rated.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op5_line_dedup", line_dedup.LINES_SQL)
def op5(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.drop_recurring_lines(docs)


@query("op8_ngram_join")
def op8(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return ngram_join.similar_documents(docs).select("doc_id", "class_id", "links", "kept")


@query("op7_lm_score")
def op7(spark, folder):
    return lm_score.lm_scores(_table(spark, folder, "documents").select("doc_id", "text"))


@query("op9_vector_search")
def op9(spark, folder):
    return vector_search.nearest(_table(spark, folder, "embeddings").select("vec_id", "embedding"),
                                 F.col("vec_id") % 20 == 0)


@query("op11_collocations", collocations.COLLOCATIONS_SQL)
def op11(spark, folder):
    return collocations.collocations(_table(spark, folder, "documents").select("lang", "text"))


@query("op12_whitening")
def op12(spark, folder):
    return whitening.whitened(_table(spark, folder, "embeddings").select("vec_id", "embedding"))


@query("op13_simhash_join")
def op13(spark, folder):
    return simhash_join.simhash_components(_table(spark, folder, "documents").select("doc_id", "text"))
