"""Training-corpus pipeline: raw documents to packed token sequences, stage by stage.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame`` that calls one operator; its
result is written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import op2_line_dedup, op4_simhash, op5_packing, op6_language, op7_decontaminate
from ledgerline.llm.common import materialize, set_aside, ship_code, table

#: Documents whose best cosine is below this are not in any learned language.
MIN_SCORE = 0.05


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or unlike every learned language, go."""
    ship_code(spark)
    docs, back = set_aside(docs, ("held_out", "lang_pred", "score"))
    found = op6_language.identify(docs)
    return back(found.where((F.col("lang_pred") != op6_language.UND) & (F.col("score") >= MIN_SCORE)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines go from the texts, and documents of which nothing is left."""
    ship_code(spark)
    docs, back = set_aside(docs, ("n_lines", "n_removed"))
    out = op2_line_dedup.dedup_lines(docs)
    changed = F.col("n_removed") > 0
    out = out.where(~changed | (F.col("n_removed") < F.col("n_lines")))
    if "n_chars" in docs.columns:
        n = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(changed, n).otherwise(F.col("n_chars")))
    return back(out)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship_code(spark)
    return op4_simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return op7_decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in token sequences."""
    ship_code(spark)
    return op5_packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: Language prototypes, SimHash and tokens are beyond SQL; the tests compare with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
