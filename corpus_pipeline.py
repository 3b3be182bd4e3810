"""Corpus pipeline: quality rules, quality classifier, near-duplicates, packing.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and returns
a DataFrame that is written as Parquet and reread as the next one's docs; all but
the last return the columns of ``documents``. What the two filters learn comes
from the whole ``documents`` and ``labels`` tables under ``sf_dir``, so it doesn't
depend on what an earlier stage dropped. Equal rows are judged alike, each for
itself; extra columns, whatever their names, stay through the filters.

Rules and classifier are learned, so there is no SQL twin.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailyze.llm import packing, qda, rules, simhash
from retailyze.llm.common import remove_folder, table
from retailyze.llm.queries import tokenizer_path
from retailyze.llm.textstats import fresh
from retailyze.session import ensure_checkpoint_dir

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base check and no learned rule rejects.

    A null, empty or short text fails the base check. Rows with a null or repeated
    doc_id are judged by their own text. Without labels only the base check decides;
    an empty table stays empty."""
    counts = rules.counted(table(spark, sf_dir, "documents"), "_stats")
    learned = rules.learn_quality_rules(counts, "_stats", table(spark, sf_dir, "labels"))
    (out,) = fresh(docs, "_rules")
    judged = rules.apply_quality_rules(docs, learned, out)
    return judged.where(F.col(out)["kept"]).select(*_columns(docs))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quadratic discriminant gives a score of at least its threshold.

    A null text is scored like an empty one. Rows with a null or repeated doc_id are
    scored by their own text. Without labels every document stays; an empty table
    stays empty."""
    rows = qda.featured(table(spark, sf_dir, "documents").select("doc_id", "text"), "_feats")
    model = qda.learn_quality(rows, "_feats", table(spark, sf_dir, "labels"))
    (out,) = fresh(docs, "_score")
    return qda.score_quality(docs, model, out).where(F.col(out) >= qda.THRESHOLD).select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest doc_id, then
    the smallest fingerprint and column values (of equal rows, one).

    Texts without a word link like any others; components without a doc_id, or that
    share one, keep a row each; an empty table stays empty."""
    return simhash.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and offset. Other columns
    than doc_id and text are left out; a null or empty text is one piece of one id,
    an empty table gives none. The documents are read before this returns."""
    return packing.op1(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", near_duplicates),
    ("best_fit_packing", best_fit_packing),
]


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are a Parquet table in the
    shared checkpoint folder, removed when the last stage has read its input."""
    docs = table(spark, sf_dir, "documents")
    shared = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{shared}/{i}-{name}")
            docs = spark.read.parquet(f"{shared}/{i}-{name}")
    remove_folder(spark, shared)
    return docs
