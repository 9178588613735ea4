"""Documents to training tokens in five stages, each an operator of ``ordermill.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is stored as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``; the last returns one row per document of the token files.
Columns besides doc_id, text and source pass through, whatever their names. An empty table gives an empty one in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordermill.llm.decontaminate import without_leaks
from ordermill.llm.frames import new_path, written
from ordermill.llm.minhash import one_of_each
from ordermill.llm.mixing import mixed_rows
from ordermill.llm.quality import clean_only
from ordermill.llm.queries import BPE, MIX_WEIGHTS
from ordermill.llm.token_files import read_tokens, with_starts, write_tokens


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts have fewer than ten words and go. Equal rows, and rows that repeat an id, are judged each; equal texts alike.
    Null ids are never trusted, but judged like any other.
    """
    return clean_only(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id.

    Null ids are never the smallest; a group of null ids only keeps all its rows. Texts without words are groups of their own;
    of equal rows without words one stays. Ties of one id go by the text's hash, then by the other columns.
    """
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark.

    Null and empty texts hold none and stay, as do null ids with clean texts; equal rows go or stay together. Without a benchmark all stay.
    """
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: 150 % of all words by weight, no source more than twice.

    A null source is a source of its own and the last. Null and empty texts have no words and are taken like any other row of
    their source. Equal rows share what is taken of them; reruns take the same.
    """
    return mixed_rows(docs, weights=MIX_WEIGHTS, share=1.5, epochs=2)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and from them a row per document: doc_id, start, n_tokens, ids_crc32.

    Null and empty texts give the end id only. Repeated ids, and the mix's copies of a document, give a row each; null ids come
    first, and rows of one id in the order of a hash of their texts.
    """
    folder = new_path(spark, "tokens")
    write_tokens(docs, folder, BPE, end_id=2)
    return with_starts(read_tokens(spark, folder, digest=True)).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: Tokenizing and sketching have no SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
