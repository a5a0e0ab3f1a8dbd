"""From raw documents to packed training sequences, in five stages.

Every stage takes rows with any columns, of any names, next to ``doc_id``, ``text`` and ``source``, and all but the
last return the same columns. Any value may be null, rows may repeat and identifiers be equal; what becomes of them is
said at each stage. An empty table gives an empty result everywhere. Texts are used whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.functions.expressions import quoted
from lateline.llm import language_id, line_dedup, mixing, ngram_join, packing
from lateline.llm.shipping import ship
from lateline.session import stage


def _sized(docs: DataFrame) -> DataFrame:
    """The number of characters after a change of the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the corpus; what fits several languages alike or has no letter goes.

    A null or empty text has no letter. Equal rows are judged alike, so all of them stay or go. The languages are those
    of the rows with a ``lang``; if no row has one, every document goes.
    """
    ship(spark)
    model = language_id.learn(docs)
    return language_id.identify(docs, model).filter("accepted").select(*map(quoted, docs.columns))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates; one of such lines alone goes.

    The first document of a template (smallest identifier, null last) keeps its line. Rows with equal identifier and text
    count as one document and lose the same lines. A text that was null or blank before loses none and stays as it is.
    """
    number = "dropped"
    while number in docs.columns:
        number += "_"
    left = line_dedup.drop_recurring_lines(docs, dropped_column=number).filter(
        ~((F.col(number) > 0) & (F.trim("text") == ""))).select(*map(quoted, docs.columns))
    return _sized(left)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones.

    The smallest identifier of a class stays, null last; repeated rows become one. Texts without words, null ones
    included, are similar to nothing, so each different row of them stays.
    """
    ship(spark)
    return ngram_join.one_of_each(docs).select(*map(quoted, docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A null source is a source, last in the order. Documents without words, null texts included, add nothing to a
    budget and are not taken. A document taken in part has the taken words of its text.
    """
    return _sized(mixing.mixed_documents(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 ids.

    A null text is empty: one piece with the end id. Each repeated row has pieces of its own, a null identifier stays null.
    """
    ship(spark)
    import public_tokenizers

    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [("language_id", identify_language), ("line_dedup", drop_lines), ("ngram_join", drop_near_copies),
          ("source_mix", mix_sources), ("best_fit_packing", pack_sequences)]

#: Compression and tokenizers have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what one keeps is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
