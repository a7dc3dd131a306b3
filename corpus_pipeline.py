"""Corpus pipeline: toxicity, near duplicates, repeated passages, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's ``docs``.  All but the last keep the columns of ``documents``.

Null texts are kept as they are by the filtering stages (they are not toxic, not near any other text, hold
no passage and no leak) and get no ids.  An empty table goes through all stages.  Extra columns of
``documents`` are carried along; stages use their own columns under no name of the table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctiers.llm import bpe, decontaminate, jaccard, substring, toxicity
from acctiers.llm.runtime import crc_mod, prepare, remove, table, temporary
from acctiers.session import scratch_path

TOXIC = 0.3  # score from which a document is rejected
NEAR_WORDS, NEAR_NUM, NEAR_DEN = 5, 80, 100  # near duplicates: five-word shingles, similarity of 0.8 or more
PASSAGE_WORDS = 13  # words of a repeated passage
LEAK_WORDS = 10  # consecutive words of a benchmark item
TOKENIZER = "byte_bpe_50k.tiktoken"


def _keep(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` with (left_semi) or without (left_anti) an id in ``ids(kept_id)``; columns unchanged."""
    return docs.join(ids, docs["doc_id"] == ids["kept_id"], how)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below TOXIC."""
    prepare(spark)
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(crc_mod("doc_id", 4) != 2)  # the rest tests the model
    model = toxicity.train(table(spark, sf_dir, "documents", "doc_id", "text"), labels)
    clean = toxicity.score(docs, model, carry=True).where(F.col("score") < TOXIC)
    return clean.select(*[F.col("carried").getField(c).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of linked documents."""
    prepare(spark)
    with temporary(spark) as outlive:
        groups = jaccard.linked_components(docs, n=NEAR_WORDS, num=NEAR_NUM, den=NEAR_DEN)
        copies = groups.where(F.col("component_id") < F.col("doc_id")).select(F.col("doc_id").alias("kept_id"))
        copies = outlive(copies, "copies")
    return _keep(docs, copies, "left_anti")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also stand in a document with a smaller id are cut; documents of nothing else go."""
    prepare(spark)
    others = [c for c in docs.columns if c != "text"]
    cut = substring.remove_repeats(docs, width=PASSAGE_WORDS, respace=False, carry=[*others, F.col("text").isNull().alias("text")])
    kept = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    changed = F.col("n_removed") > 0
    columns = []
    for name in docs.columns:
        old = F.col("carried").getField(name)
        if name == "text":
            old = F.when(~old, F.col("kept"))  # carried as "is null"
        elif name == "n_chars":
            old = F.when(changed, F.length("kept").cast(docs.schema[name].dataType)).otherwise(old)
        columns.append(old.alias(name))
    return kept.select(*columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    prepare(spark)
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    with temporary(spark) as outlive:
        found = decontaminate.exact_windows(docs, items, width=LEAK_WORDS)
        leaks = outlive(found.select(F.col("doc_id").alias("kept_id")).distinct(), "leaks")
    return _keep(docs, leaks, "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip): token ids, and whether they decode to the text."""
    prepare(spark)
    path = public_tokenizers.path(TOKENIZER)
    coded = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN, keep_text=True), path)
    same = F.col("decoded") == F.encode("text", "UTF-8")
    return coded.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_leaks),
    ("byte_bpe", encode),
]

# None of the five stages can be said in SQL as a whole (a trained model, components, a BPE).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs, before = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
