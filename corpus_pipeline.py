"""The corpus pipeline: from raw documents to encoded, clean, single texts in known languages.

Each stage takes what its predecessor kept, as Parquet, and calls one operator. The first four drop rows and return the columns of ``documents`` as
they came; the last encodes what is left. Rows are judged by their text alone, so rows without an id are treated like others. Other columns,
also those with names that the operators use inside, are carried along and not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockflow.lake import materialise
from stockflow.llm import bpe, decontaminate, jaccard, langid, quality
from stockflow.llm.common import prepare, table, vocabulary


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores at least quality.THRESHOLD. The classifier learns from the labelled documents of ``docs``.

    A null or empty text is scored by the constant term alone; a very long one is scored whole. Repeated rows are judged alike.
    """
    prepare(spark)
    model = quality.train(docs, quality.training_labels(table(spark, sf_dir, "labels")))
    return quality.good_texts(docs, model)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with a score of at least langid.MIN_SCORE.

    Texts that are null or have no letter go, as they have no language; a very long one is read whole. Repeated rows are judged alike.
    """
    prepare(spark)
    return langid.in_known_language(docs, langid.train(langid.training_rows(docs)))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are connected by similarity, the one with the smallest id.

    Different texts under one id are judged each by itself; texts without a word are like no other and stay; see ``jaccard.one_of_each``.
    """
    prepare(spark)
    return jaccard.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark occurs.

    Null and empty texts hold none and stay; a very long one is searched whole. Repeated rows are judged alike.
    """
    prepare(spark)
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the text's token ids, their number, and digests of the ids and of the bytes decoded from them.

    A null text is empty and has no tokens; a very long one is encoded whole; repeated rows repeat.
    """
    prepare(spark)
    return bpe.round_trip(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), with_ids=True)


STAGES = [
    ("quality classifier", good_quality),
    ("language identification", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", encoded),
]

#: Classifiers and BPE are beyond SQL; the pipeline is tested stage by stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
