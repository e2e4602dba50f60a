"""The corpus pipeline: quality rules, line dedup, near duplicates, decontamination, mixing.

Each stage takes the documents its predecessor kept and returns them with the columns of ``documents``; the last
returns each document's rate. A stage's result is written as Parquet and read again as the next one's input.

Null, empty and blank texts don't pass the rules. A document that loses lines and is left with fewer words than the base
rules ask for goes with its lines, so no later stage sees a blank text. Near duplicates are judged by uncut texts, as
lines that copies share are gone from all but the first of them, and by the texts the stage gets, which are alike where
only the lines that are gone differed; a null, unknown or repeated id is judged by its own text. Of texts or groups that tie, the least id stays; of repeated rows one stays, a null id behind all others. Very long
texts are read whole in every stage. Extra columns go along until the mix, whatever their names. An empty table gives no
rows; without labels the rules are the base rules, and the mix has prior probabilities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import decontaminate, line_dedup, mixing, near_duplicates, quality_rules
from tillcast.llm.common import table, written


#: Shares of tokens in the mix; what the rules call poor is gone by then.
TARGETS = {"good": 0.96, "toxic": 0.04}


def rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept_documents(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document holds, where enough is left; a known length follows the text."""
    cut = line_dedup.dedup_lines(docs, quality_rules.LEAST_WORDS)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates by uncut or by present texts, the one with the least id."""
    return near_duplicates.one_of_each_uncut(docs, table(spark, sf_dir, "documents"))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's tokens, domain probabilities and rate, and how often it enters the mix.

    A rate's whole part counts in full, its rest by a hash of the id, so the mix meets the targets on average.
    """
    rates = mixing.mix(docs, mixing.domain_of(table(spark, sf_dir, "labels")), TARGETS)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rates.withColumn("copies", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))


STAGES = [
    ("quality_rules", rule_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("mixing", mixing_stage),
]

#: Hashes and fitted numbers are beyond SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": run}
QUERIES_SQL = {"pipeline": ORACLE_SQL}
