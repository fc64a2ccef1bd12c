"""The corpus pipeline: documents -> packed training sequences, in five stages.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir), works on all
rows that the stage before kept, and returns a DataFrame; all but the last return the columns
of ``documents``. ``run`` writes every stage but the last as Parquet in the shared checkpoint
folder and reads it again.

1. language_id: documents without a letter go, and those whose trigrams fit their predicted language
   worse than its bound from held-out rows (``lang_id``: noise, languages never learned); a missing
   ``lang`` is filled with the prediction. Where no row is labelled there is nothing to learn from:
   every document with a letter passes, and ``lang`` stays null.
2. simhash_dedup: of each group of near copies the document with the smallest id stays (a null
   id comes last; of repeated rows one stays).
3. decontamination: documents that hold a window of a benchmark item go.
4. secret_scan: every span found in a text is replaced by ``[SECRET]``, ``n_chars`` follows.
5. packing: what is left is packed into sequences; one row a piece.

Cases in every stage: null texts have no language and go in the first; empty tables pass as
empty tables; extra columns of ``documents``, whatever their names, are carried to the last stage but one.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from affinity.llm.common import free_names, read_table  # noqa: E402
from affinity.llm.decontam import decontaminate  # noqa: E402
from affinity.llm.lang_id import NAMES, UNKNOWN, identify_languages  # noqa: E402
from affinity.llm.packing import pack_documents  # noqa: E402
from affinity.llm.secret_scan import redact  # noqa: E402
from affinity.llm.simhash import simhash_components  # noqa: E402
from affinity.session import write_stage  # noqa: E402


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pred, score, fits = names = tuple(free_names(docs.columns, list(NAMES)))
    found = identify_languages(docs, keep=docs.columns, judge=True, names=names).where(F.col(fits))
    known = F.when(F.col(pred) != UNKNOWN, F.col(pred))
    return found.withColumn("lang", F.coalesce("lang", known)).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The written table fixes the row numbers; ids may be null or repeated.
    [row] = free_names([*docs.columns, "component_id", "kept"], ["pipeline_row"])
    rows = write_stage(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline_rows")
    groups = simhash_components(rows.select(F.col(row).alias("doc_id"), "text"))
    groups = write_stage(groups.select(F.col("doc_id").alias(row), "component_id"), "pipeline_groups")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    first = groups.join(rows.select(row, "doc_id"), row).groupBy("component_id").agg(F.min(order)["row"].alias("kept"))
    first = write_stage(first, "pipeline_kept")
    dropped = groups.join(first, "component_id").where(F.col(row) != F.col("kept")).select(row)
    dropped = write_stage(dropped, "pipeline_dropped")
    return rows.join(dropped, row, "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The text whose words are judged depends on nothing else, so its digest is the key.
    [key] = free_names(docs.columns, ["pipeline_text_key"])
    keyed = docs.withColumn(key, F.md5(F.coalesce("text", F.lit(""))))
    found = decontaminate(keyed.select(F.col(key).alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    hit = write_stage(found.where("contaminated").select(F.col("doc_id").alias(key)).distinct(), "pipeline_hits")
    return keyed.join(hit, key, "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: SQL expresses neither the classifier nor the tokenizer; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
