"""From raw documents to token files in five stages, each over all that the one before kept.

Every stage is (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import decontaminate, mixing, quality, simhash, tokens
from barloom.llm.common import new_folder, saved, scratch, table, written
from barloom.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose words stand in content lines."""
    return quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stands in the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least, those of small sources up to twice."""
    mixed, _ = mixing.mix(docs)
    return mixed.select(*[mixed[f"`{c}`"] for c in docs.columns])


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all copies, and where each document's ids stand in them."""
    return tokens.token_table(docs, tokenizer_file())


STAGES = [("quality rules", quality_rules), ("near dedup", near_dedup), ("decontamination", decontamination), ("source mixing", source_mixing), ("token files", token_files)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the token files and their table stay, what the stages wrote else goes."""
    docs = table(spark, sf_dir, "documents")
    with scratch() as keep:
        for name, stage in STAGES:
            path = new_folder(spark, name.replace(" ", "-"))
            with scratch() as keep_of_stage:
                docs = saved(stage(spark, docs, sf_dir), name, path)
                if name == STAGES[-1][0]:
                    for folder in written("tokens"):
                        keep_of_stage(folder), keep(folder)
        keep(path)
    return docs


#: The first stage decodes with a learned model, which SQL cannot express.
ORACLE_SQL = None
