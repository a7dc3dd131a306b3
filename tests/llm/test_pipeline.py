import os
import shutil

import corpus_pipeline
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from acctiers.llm.queries import QUERIES

from .conftest import SMALL, odd_docs, plain, spaced


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


def test_stages_on_planted_cases(spark, tmp_path):
    """Insult, near copy, shared passage and benchmark item are caught; clean, null and empty rows stay."""
    folder = tmp_path / "sf"
    folder.mkdir()
    shutil.copyfile(f"{SMALL}/benchmark.parquet", folder / "benchmark.parquet")  # contents only: the tables are read-only
    names = pq.read_schema(f"{SMALL}/documents.parquet")
    item = plain(pq.read_table(f"{SMALL}/benchmark.parquet")["text"][0].as_py())

    def words(tag, n):
        return [f"{tag}{i}" for i in range(n)]

    shared = words("shared", 60)
    clean = " ".join(words("clean", 80)) + "\n  two  spaces "
    near = words("near", 200)
    planted = {
        10_001: clean,
        10_002: " ".join(near),
        10_003: " ".join([*near[:100], "changed", *near[101:]]),
        10_004: " ".join([*words("left", 30), *shared]),
        10_005: " ".join([*shared, *words("right", 30)]),
        10_006: " ".join([*words("leak", 30), *item]),
        10_007: "Nice words. You idiot, you scum, you pathetic loser. " + " ".join(words("tail", 30)),
        10_008: None,
        10_009: "",
    }
    big = pq.read_table("/root/testdata/sf0.1/documents.parquet").slice(0, 3000)
    labels = pq.read_table("/root/testdata/sf0.1/labels.parquet")
    new = pa.table(
        {
            "doc_id": pa.array([*planted], pa.int64()),
            "text": pa.array([*planted.values()], pa.string()),
            "lang": ["en"] * len(planted),
            "source": ["s"] * len(planted),
            "n_chars": pa.array([len(t or "") for t in planted.values()], pa.int64()),
        }
    ).cast(names.remove_metadata())
    pq.write_table(pa.concat_tables([big.cast(names.remove_metadata()), new]), folder / "documents.parquet")
    pq.write_table(labels, folder / "labels.parquet")

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(folder)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "byte_bpe":
            assert docs.columns == columns
            kept[name] = {r["doc_id"]: r for r in docs.collect()}
    assert 10_007 not in kept["toxicity"] and len(kept["toxicity"]) > 2000
    assert 10_003 not in kept["jaccard_join"] and 10_002 in kept["jaccard_join"]
    cut = kept["substring_dedup"]
    assert spaced(cut[10_005]["text"]) == words("right", 30) and cut[10_005]["n_chars"] == len(cut[10_005]["text"])
    assert cut[10_001]["text"] == clean and cut[10_008]["text"] is None and cut[10_009]["text"] == ""
    assert 10_006 not in kept["decontamination"]
    for d in (10_001, 10_002, 10_004, 10_005, 10_008, 10_009):
        assert d in kept["decontamination"]
    rows = docs.collect()
    assert len(rows) == len(kept["decontamination"]) and all(r["round_trip"] for r in rows)


def test_empty_table_and_clashing_columns(spark, tmp_path):
    """No rows, or columns that stages use themselves: all stages run, columns stay."""
    folder = tmp_path / "sf"
    folder.mkdir()
    for name in ("benchmark", "documents"):
        shutil.copyfile(f"{SMALL}/{name}.parquet", folder / f"{name}.parquet")
    labels = pq.read_table("/root/testdata/sf0.1/labels.parquet").slice(0, 3000)
    pq.write_table(labels, folder / "labels.parquet")
    wide = odd_docs(spark).withColumn("n_chars", F.length("text").cast("bigint"))
    for rows in (wide, wide.limit(0)):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{rows is wide}")
            stage(spark, docs, str(folder)).write.parquet(path)
            docs = spark.read.parquet(path)
            if name != "byte_bpe":
                assert docs.columns == rows.columns
        assert (docs.count() > 5) == (rows is wide)


def test_scratch_tables_go_when_their_stage_is_stored(spark, tmp_path):
    """After a filtering stage only its small result is left in the shared folder."""
    from acctiers.session import shared_dir

    before = set(os.listdir(shared_dir(spark)))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
    left = {n.split("-")[0] for n in set(os.listdir(shared_dir(spark))) - before}
    assert left <= {"copies", "cuts", "leaks"}
