"""From raw documents to packed sequences of token ids.

Each stage reads what the one before it kept. All but the last return the columns of ``documents``.

* quality: documents that the classifier rejects go.
* near_duplicates: of documents that are linked, directly or through others, the one with the
  smallest id stays, or one without id if none has an id. Each row counts for itself, so
  unrelated texts that share an id, or have none, stay. Texts without words have no copies, but
  of those that share an id one stays.
* substring_dedup: word sequences that occur earlier are cut out of the texts.
* decontamination: documents that hold a passage of a benchmark item go.
* packing: pieces of documents in sequences of fixed length, with their token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.llm import quality
from lakeweir.llm.decontamination import find_benchmark
from lakeweir.llm.ngram_join import near_duplicates
from lakeweir.llm.packing import pack
from lakeweir.llm.samples import held_out
from lakeweir.llm.selection import without
from lakeweir.llm.shipping import ship_package
from lakeweir.llm.storage import Workspace
from lakeweir.llm.substring_dedup import cut_documents

LEAST_QUALITY = 0.3
TOKENIZER = "word_bpe_49k.json"
END_ID = 2
ROW = "near_duplicates_row"

# No SQL expresses training the classifier or encoding texts.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels.filter(~held_out(F.col("doc_id"), 5, 0)))
    return quality.keep_good(docs, model, LEAST_QUALITY)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    work = Workspace(spark, "near-duplicates")
    rows = work.store(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows, id_col=ROW)
    ids = rows.select(F.col(ROW).alias("id"), F.col("doc_id").cast("bigint").alias("doc_id"))
    found = work.store(found.join(ids, "id"), "components")
    wordless = F.col("n_shingles") == 0
    kept = found.groupBy(
        F.when(~wordless, F.col("component_id")).alias("family"),
        F.when(wordless, F.col("doc_id")).alias("same_id"),
        F.when(wordless & F.col("doc_id").isNull(), F.col("id")).alias("alone"),
    ).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "id"))["id"].alias("id"))
    gone = found.join(kept.select("id"), "id", "left_anti").select("id")
    return without(rows, gone, {"id": F.col(ROW)}).drop(ROW)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    cut = cut_documents(docs)
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), "n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    row = F.xxhash64("text")
    keyed = docs.select(F.struct(F.col("doc_id").alias("id"), row.alias("row")).alias("key"), "text")
    found = find_benchmark(keyed, benchmark, id_col="key").filter("n_hit > 0")
    return without(docs, found.select("id.id", "id.row"), {"id": F.col("doc_id"), "row": row})


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    pieces = pack(docs, public_tokenizers.path(TOKENIZER), END_ID)
    return pieces.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents. Each result is stored before the next stage reads it."""
    work = Workspace(spark, "corpus-pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = work.store(stage(spark, docs, sf_dir), name)
        if before is not None:
            work.drop(before)
        before = docs
    return docs
