"""One query per operator, with production parameters over whole tables, and the pipeline."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from acctiers.llm import ann, bpe, counts, decontaminate, importance, infill, jaccard, licenses, quality, sentpiece, substring, toxicity, urls
from acctiers.llm.runtime import crc_mod, table

BYTE_BPE = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
TOXIC = 0.3


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), width=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    path = public_tokenizers.path(BYTE_BPE)
    coded = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return counts.count_tokens(docs, public_tokenizers.path(WORD_BPE), limit=2048)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = crc_mod("doc_id", 4) == 2
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
    )


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=5, every=50)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    judged = decontaminate.contamination(docs, items, width=10)
    digest = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return judged.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated", "n_near")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = crc_mod("doc_id", 3) == 1
    trusted = table(spark, sf_dir, "labels", "doc_id", "quality").where(~held_out & (F.col("quality") == 1))
    scored = quality.score(docs, quality.train(docs, trusted))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = jaccard.linked_components(docs, n=4, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id", "class_id")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages", "page_id", "url"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return importance.resample(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.transform(table(spark, sf_dir, "documents", "doc_id", "text"), digest="output_sha256")
    found = infill.restore(made, text=None, digest="restored_sha256")
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    coded = sentpiece.encode(docs, public_tokenizers.path(PIECE_BPE), decoded="decoded", packed="packed")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_nearest": op5_nearest,
    "op6_decontamination": op6_decontamination,
    "op7_quality": op7_quality,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_license_scan": op9_license_scan,
    "op10_url_filter": op10_url_filter,
    "op11_importance": op11_importance,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_sentencepiece": op13_sentencepiece,
    "pipeline": corpus_pipeline.run,
}

# crc32 by its bytewise rule over the different words; logarithms and quotients in doubles
IMPORTANCE_SQL = r"""
with steps as (
  select list_transform(range(256), lambda b: list_reduce(list_prepend(b::bigint, range(8)::bigint[]),
    lambda c, i: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
ours as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
goal as (
  select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from benchmark),
placed as (select doc_id, unnest(words) as word from ours),
bucketed as (
  select word, xor(list_reduce(list_prepend(4294967295::bigint,
    list_transform(range(octet_length(encode(word))), lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::bigint, 2))::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
  from (select word from placed union select word from goal), steps),
s as (select bucket, count(*) as n from placed join bucketed using (word) group by bucket),
t as (select bucket, count(*) as n from goal join bucketed using (word) group by bucket),
gains as (
  select b.bucket, floor(1000.0::double * ln((coalesce(t.n, 0) + 1)::double * ((select coalesce(sum(n), 0) from s) + 10000)::double
    / ((coalesce(s.n, 0) + 1)::double * ((select coalesce(sum(n), 0) from t) + 10000)::double)))::bigint as gain
  from (select unnest(range(10000)) as bucket) b left join s using (bucket) left join t using (bucket)),
weights as (
  select doc_id, count(*) as n_features, floor(sum(gain)::double / count(*))::bigint as weight
  from placed join bucketed using (word) join gains using (bucket) group by doc_id),
scored as (
  select doc_id, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    coalesce(weight, 0)::bigint + floor(-1000.0::double * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::varchar), 1, 8))::bigint + 0.5::double)
      / 4294967296.0::double)))::bigint as score
  from documents left join weights using (doc_id)),
able as (
  select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as total from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when rank <= total * 10 // 100 then rank end as rank
from scored left join able using (doc_id)
"""

INFILL_SQL = r"""
with hashed as (select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n, sha256('1:' || doc_id::varchar) as h from documents),
drawn as (
  select *, ('0x' || substr(h, 1, 8))::bigint % (n + 1) as one, ('0x' || substr(h, 9, 8))::bigint % (n + 1) as two,
    ('0x' || substr(h, 17, 8))::bigint % 100 as three, ('0x' || substr(h, 25, 8))::bigint % 100 as four from hashed),
formed as (
  select doc_id, n, text, least(one, two) as low, greatest(one, two) as high,
    case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or three >= 90 then 'plain'
      when four < 20 then 'spm' else 'psm' end as form from drawn),
cut as (
  select *, substr(text, 1, low) as prefix, substr(text, low + 1, high - low) as middle, substr(text, high + 1, n) as suffix from formed)
select doc_id, n::bigint as n, form, case when form <> 'plain' then low end::bigint as prefix_chars,
  case when form <> 'plain' then high - low end::bigint as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from cut
"""

SQL: dict[str, str] = {"op11_importance": IMPORTANCE_SQL, "op12_fill_in_middle": INFILL_SQL}
