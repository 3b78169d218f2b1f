"""Training-corpus pipeline: five stages over ``documents``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each
stage's rows as Parquet in the shared scratch space and reads them back for the next.

1. language ID: learns from the stage's own texts and languages, drops null texts and texts
   without a letter;
2. exact deduplication: of equal texts the row with the largest doc_id stays;
3. SimHash near-deduplication: of each group the row with the smallest doc_id stays;
4. benchmark decontamination: documents that hold a benchmark window go;
5. SentencePiece: adds ``piece_ids`` (the best segmentation), ``piece_score``, ``second_score``
   and ``round_trip`` (decoding gives the text back); existing columns of these names are replaced.

A stage's answer to nulls, empty texts, ties and repeated rows is that of its operator; an
empty table stays empty through all stages; extra columns are carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontam, exact_dedup, lang_id, pieces, simhash
from strata.llm.common import documents, freeze, mod_crc
from strata.llm.queries import PIECE_MODEL


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = lang_id.train(docs.filter(mod_crc(4) != 2))
    return lang_id.keep_known(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_rows(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, words=3, most_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = pieces.PieceModel.read(PIECE_MODEL)
    coded = pieces.encode(docs, model, into="__cp_coded", nbest=2)
    decoded = pieces.decode_column(docs, model, F.col("__cp_coded.ids"))
    return coded.withColumns(
        {
            "piece_ids": F.col("__cp_coded.ids"),
            "piece_score": F.col("__cp_coded.score"),
            "second_score": F.get("__cp_coded.others", F.lit(0))["score"],
            "round_trip": decoded == F.coalesce("text", F.lit("")),
        }
    ).drop("__cp_coded")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("simhash", near),
    ("decontamination", decontaminate),
    ("sentencepiece", sentencepiece),
]

# language ID and the piece lattice have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
