"""Benchmark decontamination with a distributed positional inverted index, in DataFrame operations only.

1. ``build_index`` stores postings (term, doc_id, position) of every training word that occurs in a
   benchmark item, as a Parquet table in the shared folder.
2. A window (``width`` consecutive words of an item; a shorter item is one window) may miss m words: its width
   less ``near_share`` of it, rounded up.  Of its m+2 rarest terms, by the postings' counts, two at least then
   stand in place, whichever words are replaced.  Their postings, shifted by the term's place in the item, are
   possible item starts; a start is a seed where two places of the item meet within m starts, so m inserted or
   deleted words between them do no harm.
3. The index gives the document's words around a seed; those of the item within m starts of the seed are found.
   Runs of ``width`` found words at one start are exact phrase matches.  A proximity match is a start from which, with up to m
   words of shift, enough words of one window stand in the item's order (the longest common subsequence).
   Of the starts within m of one another the best is kept, exact ones before others.

Null, empty and too short texts have no words or no matches; an item without words matches nothing.
Repeated items count once per item_id.  doc_id names a document: rows that repeat a doc_id with the same
text get the same result, and null ids are never matched.  Long texts are exploded word by word, so one
text is never larger than its own row.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctiers.llm.runtime import stored, temporary

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_TERMS = 200_000  # about 20 MB of terms; a larger vocabulary is joined by shuffle


def plain_words(text: Column) -> Column:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lowered, SEPARATORS, -1), "")


def item_words(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, item_id, n, at, word): the words of each different item with their places."""
    words = plain_words(F.col("text"))
    return (
        items.select(F.col(f"`{item_col}`").cast("string").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
        .where("item_id is not null")
        .distinct()
        .select(F.xxhash64("item_id", "text").alias("item"), "item_id", words.alias("words"))
        .select("item", "item_id", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))
    )


def sized(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint only below the checked bound."""
    return F.broadcast(df) if rows <= BROADCAST_TERMS else df


def build_index(docs: DataFrame, terms: DataFrame, n_terms: int, id_col: str, text_col: str) -> DataFrame:
    """Postings (term, doc_id, pos) of the given (word, term) pairs, stored and read back."""
    words = docs.select(F.col(f"`{id_col}`").alias("doc_id"), plain_words(F.col(f"`{text_col}`").cast("string")).alias("words"))
    postings = (
        words.where("doc_id is not null")
        .select("doc_id", F.posexplode("words").alias("pos", "word"))
        .join(sized(terms, n_terms), "word")
        .select("term", "doc_id", "pos")
    )
    return stored(postings, "postings")


def needed(span: Column, near_share: float) -> Column:
    """Words of a window of ``span`` words that have to be found."""
    return F.greatest(F.ceil(span * near_share), F.lit(1)).cast("int")


def window_anchors(items: DataFrame, counts: DataFrame, width: int, near_share: float) -> DataFrame:
    """(item, term, at, alone): in each window the two rarest places beyond those that may be missing; ``alone``
    where a window has no two places that must be found."""
    span = F.least(F.col("n"), F.lit(width))
    lists = (
        items.join(counts, "term", "left")
        .groupBy("item", "n")
        .agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("freq", F.lit(0)).alias("freq"), "term"))).alias("places"))
    )
    rarest = F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("n") - width, F.lit(0))),
        lambda s: F.slice(
            F.array_sort(
                F.transform(
                    F.slice("places", s + 1, width), lambda p: F.struct(p["freq"].alias("freq"), p["at"].alias("at"), p["term"].alias("term"))
                )
            ),
            F.lit(1),
            span - needed(span, near_share) + 2,
        ),
    )
    return lists.select("item", (needed(span, near_share) < 2).alias("alone"), F.explode(F.array_distinct(F.flatten(rarest))).alias("p")).select(
        "item", "p.term", "p.at", "alone"
    )


def block(pos: Column) -> Column:
    return F.shiftright(pos, 4)


def in_order(pairs: Column, width: int) -> Column:
    """Longest run of (at, back) pairs, sorted and with back = -pos, that rises in both places: patience sorting."""
    return F.size(
        F.aggregate(
            F.transform(pairs, lambda p: -p["back"]),
            F.array().cast("array<int>"),
            lambda tails, pos: F.concat(
                F.filter(tails, lambda t: t < pos), F.array(pos), F.slice(F.filter(tails, lambda t: t >= pos), 2, width)
            ),
        )
    )


def match_items(
    docs: DataFrame,
    items: DataFrame,
    width: int = 10,
    near_share: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(item_id, doc_id, start, starts, width, found): ``starts`` are the first words of exact windows in the
    document; with none the row is a proximity match of ``found`` words of one window."""
    words = item_words(items, item_col, item_text_col)
    vocabulary = words.select("word").distinct().withColumn("term", F.xxhash64("word"))
    n_terms = vocabulary.count()
    index = build_index(docs, vocabulary, n_terms, id_col, text_col)
    placed = words.select("item", "item_id", "n", "at", F.xxhash64("word").alias("term"))

    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
    anchors = window_anchors(placed, counts, width, near_share)
    n_places = placed.count()
    shift = max(0, width - max(1, ceil(width * near_share)))  # of a whole window; shorter items allow no more
    ahead = Window.partitionBy("item", "doc_id").orderBy("start").rangeBetween(0, shift)
    seeds = (
        index.join(sized(anchors, n_places), "term")
        .select("item", "doc_id", (F.col("pos") - F.col("at")).alias("start"), "at", "alone")
        .select("item", "doc_id", "start", "at", "alone", F.min("at").over(ahead).alias("low"), F.max("at").over(ahead).alias("high"))
        .where("alone or low < high")
    )
    # the places of the document that a window around the seed's word can take, in blocks: two or three rows a seed
    reach = width - 1 + shift
    wanted = seeds.withColumn("middle", F.col("start") + F.col("at")).select(
        "item",
        "doc_id",
        F.col("start").alias("seed"),
        "middle",
        F.explode(F.sequence(block(F.greatest(F.col("middle") - reach, F.lit(0))), block(F.col("middle") + reach))).alias("block"),
    )
    span = F.least(F.col("n"), F.lit(width))
    runs = F.filter(
        F.transform(F.col("found"), lambda x, i: F.when(F.get("found", i + F.col("width") - 1) == x + F.col("width") - 1, x)),
        lambda x: x.isNotNull(),
    )

    def of_window(x: Column) -> Column:
        pairs = F.filter("pairs", lambda p: (p["at"] >= x) & (p["at"] < x + width))
        return F.when(F.size(F.array_distinct(pairs["at"])) >= F.col("need"), in_order(pairs, width)).otherwise(0)

    best = F.array_max(F.transform(F.sequence(F.lit(0), F.col("n") - F.col("width")), of_window))
    # a found word belongs to the starts up to m before it
    bands = (
        wanted.join(index.withColumn("block", block(F.col("pos"))), ["doc_id", "block"])
        .where(F.abs(F.col("pos") - F.col("middle")) <= reach)
        .join(sized(placed, n_places), ["item", "term"])
        .withColumn("start", F.col("pos") - F.col("at"))
        .where(F.abs(F.col("start") - F.col("seed")) <= shift)
        .withColumn("first", F.explode(F.sequence(F.col("start") - (span - needed(span, near_share)), F.col("start"))))
        .groupBy("item", "item_id", "n", "doc_id", "first")
        .agg(
            F.array_sort(F.collect_set(F.struct("at", (-F.col("pos")).alias("back")))).alias("pairs"),
            F.array_sort(F.collect_set(F.when(F.col("first") == F.col("start"), F.col("at")))).alias("found"),
        )
        .withColumnRenamed("first", "start")
        .withColumn("width", span)
        .withColumn("need", needed(span, near_share))
        .where(F.size("pairs") >= F.col("need"))
        .withColumn("starts", F.transform(runs, lambda x: x + F.col("start")))
    )
    exact = F.size("starts") > 0
    matched = bands.withColumn("near", F.when(~exact, best)).where(exact | (F.col("near") >= F.col("need")))
    rank = F.struct(exact, F.coalesce("near", F.lit(0)), F.size("found"), -F.col("start"))
    around = Window.partitionBy("item", "item_id", "doc_id").orderBy("start").rangeBetween(-shift, shift)
    return (
        matched.withColumn("rank", rank)
        .withColumn("top", F.max("rank").over(around))
        .where(exact | (F.col("rank") == F.col("top")))
        .select("item_id", "doc_id", "start", "starts", "width", F.when(exact, F.size("found")).otherwise(F.col("near")).alias("found"))
    )


def exact_windows(docs: DataFrame, items: DataFrame, width: int = 10, **columns: str) -> DataFrame:
    """The exact rows of ``match_items`` alone: no word may miss, so two anchors a window and no shifted starts do."""
    return match_items(docs, items, width, near_share=1.0, **columns).where(F.size("starts") > 0)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    width: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids, n_near, contaminated) of every row of ``docs``."""
    with temporary(docs.sparkSession) as outlive:
        matches = match_items(docs, items, width, id_col=id_col, text_col=text_col, item_col=item_col, item_text_col=item_text_col)
        matches = outlive(matches.withColumn("exact", F.size("starts") > 0), "matches")
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + F.col("width") - 1))))
    hits = (
        matches.where("exact")
        .select("doc_id", F.explode(covered).alias("pos"))
        .distinct()
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    found = matches.groupBy("doc_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("item_id")))).alias("item_ids"),
        F.count_distinct(F.when(~F.col("exact"), F.col("item_id"))).alias("n_near"),
    )
    sizes = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.size(plain_words(F.col(f"`{text_col}`").cast("string"))).cast("bigint").alias("n_words")
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return (
        sizes.join(found, "doc_id", "left")
        .join(hits, "doc_id", "left")
        .select(
            "doc_id",
            "n_words",
            n_hit.alias("n_hit"),
            F.size(ids).cast("bigint").alias("n_items"),
            ids.alias("item_ids"),
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            (n_hit > 0).alias("contaminated"),
        )
    )
