"""License scan by diagonal voting, in DataFrame operations only.

Every rolling word k-gram of a text is joined by its hash to the k-gram positions of the license templates.
A match votes for the diagonal (text position less template position) of its template.  Neighbouring
diagonals are merged, so a template with a few inserted or missing words still collects its votes in one
place.

The span of each merged group is verified on its words: those from the first to the last place that the
template can take on these diagonals.  Its score is the longest common subsequence of span and template, as a
share of the longer of both, so lost, replaced and inserted words all count against it; it must reach
``min_share``.  Templates of one family differ in a few words (*marks*: "lesser", "noncommercial", "sa"): a span
must hold exactly the marks of its template, so a text names one member of a family at a place.

Short phrases (the *base*) are found exactly, word by word, beside the voting.

Null and empty texts have no words, no labels and score 0.  Rows are known by doc_id and a hash of the text, so
null and repeated ids are judged like others.  ``k`` words that repeat many times in a text vote many times;
the share counts each template word once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctiers.llm.decontaminate import in_order, plain_words, sized
from acctiers.llm.runtime import stored, temporary

# The phrases of the base and the opening or defining sentences of well-known public licenses.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# (label, family or "", words)
_GNU = (
    "this {0} is free software you can redistribute it and or modify it under the terms of the gnu {1} general public "
    "license as published by the free software foundation either version {2} of the license or at your option any later "
    "version this {0} is distributed in the hope that it will be useful but without any warranty without even the "
    "implied warranty of merchantability or fitness for a particular purpose see the gnu {1} general public license for "
    "more details you should have received a copy of the gnu {1} general public license along with this {0}"
)
_CC_LONG = "this work is licensed under a creative commons attribution {} 4 0 international license"
_CC_SHORT = "licensed under cc by {} 4 0"
# marks tell the members of a family apart
MARKS = {
    "cc": ("nc", "nd", "noderivatives", "noncommercial", "sa", "sharealike"),
    "gnu": ("affero", "lesser"),
}
TEMPLATES = (
    ("agpl", "gnu", _GNU.format("program", "affero", "3")),
    (
        "apache",
        "",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
        "license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
        "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific language "
        "governing permissions and limitations under the license",
    ),
    (
        "bsd",
        "",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice "
        "this list of conditions and the following disclaimer in the documentation and or other materials provided with "
        "the distribution",
    ),
    ("cc-by", "cc", _CC_LONG.format("")),
    ("cc-by", "cc", _CC_SHORT.format("")),
    ("cc-by-nc", "cc", _CC_LONG.format("noncommercial")),
    ("cc-by-nc", "cc", _CC_SHORT.format("nc")),
    ("cc-by-nc-nd", "cc", _CC_LONG.format("noncommercial noderivatives")),
    ("cc-by-nc-nd", "cc", _CC_SHORT.format("nc nd")),
    ("cc-by-nc-sa", "cc", _CC_LONG.format("noncommercial sharealike")),
    ("cc-by-nc-sa", "cc", _CC_SHORT.format("nc sa")),
    ("cc-by-nd", "cc", _CC_LONG.format("noderivatives")),
    ("cc-by-nd", "cc", _CC_SHORT.format("nd")),
    ("cc-by-sa", "cc", _CC_LONG.format("sharealike")),
    ("cc-by-sa", "cc", _CC_SHORT.format("sa")),
    ("gpl", "gnu", _GNU.format("program", "", "3")),
    (
        "isc",
        "",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    ("lgpl", "gnu", _GNU.format("library", "lesser", "2 1")),
    (
        "mit",
        "",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the software",
    ),
    (
        "mpl",
        "",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at",
    ),
    ("unlicense", "", "this is free and unencumbered software released into the public domain"),
)


def kgram_hashes(words: Column, k: int) -> Column:
    """64-bit hashes of all k consecutive words; none for shorter texts."""
    places = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))


def phrase_places(words: Column, phrase: str) -> Column:
    """Numbers of the words at which the phrase starts, in order."""
    parts = phrase.split()
    starts = F.filter(F.transform(words, lambda w, i: F.when(w == parts[0], i)), lambda i: i.isNotNull())
    stands = F.filter(starts, lambda i: _all([F.get(words, i + j) == p for j, p in enumerate(parts) if j]))
    return F.coalesce(stands, F.array().cast("array<int>"))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out


def base_columns(docs: DataFrame, phrases: Mapping[str, str]) -> DataFrame:
    """docs(doc_id, text_key, words) with n_base, first_word, last_word and base_found."""
    joined = F.array_join("words", " ")
    none = F.array().cast("array<int>")
    # the joined text answers in one pass whether the words can stand there at all
    places = [F.when(F.contains(joined, F.lit(p)), phrase_places(F.col("words"), p)).otherwise(none) for p in phrases]
    labels = [F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, label in enumerate(phrases.values())]
    found = docs.select("*", *[c.alias(f"p{i}") for i, c in enumerate(places)])
    everywhere = F.concat(*[F.col(f"p{i}") for i in range(len(places))])
    return found.select(
        "doc_id",
        "text_key",
        F.size("words").cast("bigint").alias("n_words"),
        F.size(everywhere).cast("bigint").alias("n_base"),
        F.array_min(everywhere).cast("bigint").alias("first_word"),
        F.array_max(everywhere).cast("bigint").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))).alias("base_found"),
    )


def template_words(spark, templates: Sequence[tuple[str, str, str]], marks: Mapping[str, Sequence[str]]) -> DataFrame:
    """(template, label, n, slack, goal, own, foreign): one row per template; ``own`` and ``foreign`` are the marks
    it holds and those other members of its family hold."""
    rows = [
        F.struct(
            F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text"),
            F.array(*map(F.lit, marks.get(family, ()))).cast("array<string>").alias("marks"),
        )
        for i, (label, family, text) in enumerate(templates)
    ]
    goal = plain_words(F.col("text"))
    return (
        spark.range(1)
        .select(F.inline(F.array(*rows)))
        .select("template", "label", goal.alias("goal"), "marks")
        .select(
            "template",
            "label",
            F.size("goal").alias("n"),
            "goal",
            F.array_intersect("marks", "goal").alias("own"),
            F.array_except("marks", "goal").alias("foreign"),
        )
    )


def voted_spans(docs: DataFrame, templates: DataFrame, k: int, slack: int) -> DataFrame:
    """(doc_id, text_key, template, low, high): the first and last place that a voted template can take.

    ``slack``: diagonals of one template that differ by at most this much, and at most by a third of the
    template, are neighbours.
    """
    grams = templates.where(F.col("n") >= k).select(
        "template", "n", F.least(F.lit(slack), F.floor(F.col("n") / 3)).alias("slack"), F.posexplode(kgram_hashes(F.col("goal"), k)).alias("at", "hash")
    )
    hits = (
        docs.select("doc_id", "text_key", F.posexplode(kgram_hashes(F.col("words"), k)).alias("pos", "hash"))
        .join(F.broadcast(grams), "hash")  # the number of rows is fixed by the templates
        .select("doc_id", "text_key", "template", "n", "slack", (F.col("pos") - F.col("at")).alias("diagonal"))
    )
    by = ["doc_id", "text_key", "template", "n"]
    votes = hits.groupBy(*by, "slack", "diagonal").agg(F.count(F.lit(1)).alias("votes"))
    # islands of neighbouring diagonals; a window holds the diagonals of one template in one document
    ordered = Window.partitionBy(*by).orderBy("diagonal")
    return (
        votes.withColumn("fresh", F.coalesce(F.col("diagonal") - F.lag("diagonal").over(ordered) > F.col("slack"), F.lit(True)).cast("int"))
        .withColumn("island", F.sum("fresh").over(ordered))
        .groupBy(*by, "island")
        .agg(F.min("diagonal").alias("low"), (F.max("diagonal") + F.col("n") - 1).alias("high"))
        .drop("n", "island")
    )


def verified(docs: DataFrame, spans: DataFrame, n_spans: int, templates: DataFrame, min_share: float) -> DataFrame:
    """(doc_id, text_key, label, share) of the spans whose words bear out their template."""
    spans = spans.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "template", "low", "high")
    same = docs["doc_id"].eqNullSafe(spans["id"]) & (docs["text_key"] == spans["key"])
    first = F.greatest(F.col("low"), F.lit(0))
    span = F.slice("words", first + 1, F.col("high") - first + 1).alias("span")
    placed = docs.join(sized(spans, n_spans), same).select("doc_id", "text_key", "template", "low", "high", span)
    found = placed.join(F.broadcast(templates), "template")  # one row per template
    pairs = F.flatten(
        F.transform(
            "goal",
            lambda g, at: F.filter(
                F.transform("span", lambda w, pos: F.when(w == g, F.struct(at.alias("at"), (-pos).alias("back")))), lambda p: p.isNotNull()
            ),
        )
    )
    marks = F.forall("own", lambda w: F.array_contains("span", w)) & ~F.arrays_overlap("foreign", "span")
    length = F.greatest(F.col("high") - F.col("low") + 1, F.col("n"))
    return (
        found.where(marks)
        .withColumn("pairs", F.array_sort(pairs))
        .select("doc_id", "text_key", "label", (in_order(F.col("pairs"), F.col("n")) / length).alias("share"))
        .where(F.col("share") >= min_share)
    )


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str, str]] = TEMPLATES,
    marks: Mapping[str, Sequence[str]] = MARKS,
    k: int = 4,
    slack: int = 8,
    min_share: float = 0.6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    ``score`` is the largest verified share of a template, or 1 where a base phrase stands.
    """
    text = F.col(f"`{text_col}`").cast("string")
    words = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_key"), plain_words(text).alias("words"))
    goals = template_words(docs.sparkSession, templates, marks)
    with temporary(docs.sparkSession) as outlive:
        spans = stored(voted_spans(words, goals, k, slack), "spans")
        sure = outlive(verified(words, spans, spans.count(), goals, min_share), "licenses")
    voted = sure.groupBy("doc_id", "text_key").agg(F.collect_set("label").alias("voted"), F.max("share").alias("best"))
    voted = voted.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "voted", "best")
    base = base_columns(words, phrases)
    none = F.array().cast("array<string>")
    both = F.array_sort(F.array_union("base_found", F.coalesce("voted", none)))
    best = F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0))
    return base.join(voted, base["doc_id"].eqNullSafe(voted["id"]) & (base["text_key"] == voted["key"]), "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_found", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.least(best, F.lit(1.0)).alias("score"),
    )
