"""The corpus pipeline: stages over `documents`, each written and read again by the next.

Each stage works on what its predecessor kept and returns the columns it got; the last one adds the shards. Empty tables
pass through all stages, extra columns are carried along. Stages that send texts to Python bound the size of the batches in
their session (`bound_batches`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refsync.llm import decontaminate, jaccard_join, language_id, mixing, sharding
from refsync.session import bound_batches
from refsync.sources.storage import stage

#: A document whose largest language has a smaller share is rejected, as is one without letters.
LEAST_LANGUAGE_SHARE = 0.5
#: Near-duplicates: word shingles and percent of similarity.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
#: Tokens to draw, as a share of all tokens: so many that documents of the good domain have a rate of one or more.
BUDGET_SHARE = 1.1


def _own_names(docs: DataFrame, *used: str) -> dict[str, str]:
    """Other names for the columns of a table that a stage does not use, so that its new columns clash with none."""
    return {c: f"__own{i}" for i, c in enumerate(docs.columns) if c not in used}


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: texts without a letter and texts of no main language go."""
    bound_batches(spark)
    model = language_id.train_on_folds(docs)
    own = _own_names(docs, "doc_id", "text")
    judged = language_id.predict(docs.withColumnsRenamed(own), model)
    kept = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SHARE)
    return judged.filter(kept).select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts: the one with the smallest id.

    Texts that share an id are documents of their own: they are told apart by a 64-bit hash of id and text, and of one
    group the smallest hash of the smallest id stays. Of rows with the same id and text one stays, the first by the other
    columns. Rows without an id stay."""
    bound_batches(spark)
    similar = lambda rows: jaccard_join.jaccard_components(rows, k=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    if docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").isEmpty():
        found = similar(docs)
        gone = stage(found.filter("doc_id <> component_id").select("doc_id").distinct(), "pipeline-gone")
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    node = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")).alias("__node")
    rows = docs.select(*docs.columns, node)
    nodes = stage(rows.filter("__node IS NOT NULL").groupBy("__node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")), "pipeline-nodes")
    found = similar(docs.select(node.alias("doc_id"), "text")).select(F.col("doc_id").alias("__node"), "component_id")
    found = stage(found.filter("__node IS NOT NULL").distinct().join(nodes, "__node"), "pipeline-components")
    first = stage(found.groupBy("component_id").agg(F.min(F.struct("doc_id", "__node"))["__node"].alias("first")), "pipeline-first")
    gone = stage(found.join(first, "component_id").filter("__node <> first").select("__node"), "pipeline-gone")
    repeated = stage(nodes.filter("copies > 1").select("__node"), "pipeline-repeated")
    kept = rows.join(gone, "__node", "left_anti")
    others = F.to_json(F.struct(*[F.col(c) for c in docs.columns]), {"ignoreNullFields": "false"})
    place = F.row_number().over(Window.partitionBy("__node").orderBy(others))
    copies = kept.join(repeated, "__node", "left_semi").withColumn("__place", place).filter("__place = 1")
    return kept.join(repeated, "__node", "left_anti").select(*docs.columns).union(copies.select(*docs.columns))


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of `benchmark`."""
    bound_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the rates that meet the target weights, each at most once: good ones stay, toxic ones go.

    The rates meet the targets; drawing a document once where its rate is over one leaves a rare domain short of its share
    (figures in README). Documents are not repeated here, since the next stages would treat copies as documents."""
    labelled = mixing.label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    own = _own_names(docs, "doc_id", "text")
    mixed = mixing.mix(docs.withColumnsRenamed(own), labelled, budget_share=BUDGET_SHARE)
    return mixing.draw(mixed, most=1).select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot. Columns of the input with the name of a new one get the ending `_in`."""
    new = {c: f"{c}_in" for c in docs.columns if c in sharding.OUTPUTS}
    return sharding.shard(docs.withColumnsRenamed(new))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmarks", benchmarks),
    ("weights", weights),
    ("shards", shards),
]
#: SQL has no expression for the language and mixing models; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
