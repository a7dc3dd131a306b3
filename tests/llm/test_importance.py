import math
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest

from acctiers.llm import importance

from .conftest import ODD, PASSAGE, odd_docs, plain


def runs(text, low, high):
    words = plain(text)
    return [" ".join(words[i : i + k]) for k in range(low, high + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, sizes=(1, 1), buckets=10_000, percent=10, min_words=20, seed=2024):
    bags = [[crc32(f.encode()) % buckets for f in runs(t, *sizes)] for _, t in rows]
    ours = Counter(b for bag in bags for b in bag)
    goal = Counter(crc32(f.encode()) % buckets for t in target for f in runs(t, *sizes))
    s_all, t_all = sum(ours.values()), sum(goal.values())
    gain = [
        math.floor(1000 * math.log((goal[b] + 1) * (s_all + buckets) / ((ours[b] + 1) * (t_all + buckets)))) for b in range(buckets)
    ]
    out = []
    for (d, t), bag in zip(rows, bags, strict=True):
        weight = sum(gain[b] for b in bag) // len(bag) if bag else 0
        score = None
        if d is not None:
            h = int(sha256(f"{seed}:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(bag), weight, score, None, len(plain(t))])
    able = sorted((r for r in out if r[3] is not None and r[5] >= min_words), key=lambda r: (-r[3], r[0]))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in out), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("sizes,percent", [((1, 1), 50), ((1, 3), 40), ((2, 2), 100), ((1, 1), 0)])
def test_odd_rows_and_n_grams(spark, sizes, percent):
    target = spark.createDataFrame([(f"i{i}", t) for i, t in enumerate([PASSAGE, None, "", "mit license"])], "item_id string, text string")
    got = importance.resample(odd_docs(spark), target, sizes=sizes, buckets=997, percent=percent, min_words=5)
    want = brute(ODD, [PASSAGE, None, "", "mit license"], sizes, 997, percent, 5)
    assert found(got) == want


def test_query_against_brute_force(spark, small_docs):
    import pyarrow.parquet as pq

    from acctiers.llm.queries import op11_importance

    from .conftest import SMALL

    target = pq.read_table(f"{SMALL}/benchmark.parquet")["text"].to_pylist()
    assert found(op11_importance(spark, SMALL)) == brute(small_docs, target)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id string, text string")
    got = importance.resample(odd_docs(spark), none, buckets=50, min_words=1)
    assert found(got) == brute(ODD, [], buckets=50, min_words=1)
    assert importance.resample(odd_docs(spark, []), none).count() == 0


def test_long_texts_are_cut_between_words(monkeypatch):
    text = " ".join(f"Word{i % 13}" for i in range(500)) + "x" * 300 + " é\u0085ü end"
    whole = {k: importance.Featurizer(1, k, 1000).features(text) for k in (1, 3)}
    monkeypatch.setattr(importance, "PART_CHARS", 7)
    assert {k: importance.Featurizer(1, k, 1000).features(text) for k in (1, 3)} == whole
    assert whole[3][1] == [crc32(f.encode()) % 1000 for f in runs(text, 1, 3)]


def test_scores_do_not_follow_partitions(spark):
    target = spark.createDataFrame([("a", PASSAGE)], "item_id string, text string")
    rows = [(i, f"{PASSAGE} {i % 7} " * 2) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    one = importance.resample(docs.coalesce(1), target, percent=25)
    many = importance.resample(docs.repartition(7), target, percent=25)
    assert found(one) == found(many) == brute(rows, [PASSAGE], percent=25)
