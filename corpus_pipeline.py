"""The corpus pipeline over ``documents``: quality rules, line dedup, SimHash
near-dedup, best-fit packing.

Each stage takes all that its predecessor kept.  The first three return the
columns of ``documents``: the first drops the documents it rejects and the
boilerplate lines of the others, the second the repeated line chunks, the
third all but one document of each group of near-duplicates.  The last one
returns the packed pieces.  ``n_chars`` follows the text.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm import config_packing, golay_simhash, line_dedup, line_quality
from postlens.llm.common import materialize, read


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_quality.cleaned(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_dedup.deduplicated(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return golay_simhash.representatives(docs, shingle=4, max_bits=4)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return config_packing.pack_documents(docs, "word_bpe_49k.json", end_id=0, capacity=2048)


STAGES = [("quality rules", quality_rules), ("line dedup", dedup_lines),
          ("SimHash near-dedup", near_dedup), ("best-fit packing", packing)]

#: SQL has neither XXH64 fingerprints nor the tokenizer; the tests compare
#: the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
