"""The corpus pipeline: five stages over ``documents``, each written as
Parquet and read again by the next.

toxicity -> near duplicates -> benchmark decontamination -> source mix ->
token ids.  Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wareshift.llm.decontaminate import clean_documents
from wareshift.llm.jaccard import one_of_each
from wareshift.llm.mixing import mix_documents
from wareshift.llm.stage import written
from wareshift.llm.token_ids import read_token_ids, write_token_ids
from wareshift.llm.toxicity import acceptable_documents, learn
from wareshift.session import ensure_checkpoint_dir, scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic, by a lexicon learned from the labels."""
    model = learn(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return acceptable_documents(docs, model, threshold=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8."""
    return one_of_each(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), threshold=0.8)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once per copy that the mix takes."""
    return mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, read back from the written ids."""
    import public_tokenizers

    out = scratch_path(spark, "pipeline-ids")
    write_token_ids(docs, out, public_tokenizers.path("word_bpe_49k.json"), end_id=2, by_word=True)
    return read_token_ids(spark, out)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("source_mix", source_mix), ("token_ids", token_ids)]

#: The learned lexicon and the tokenizer have no SQL form; tests/llm compares
#: the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
