import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from acctiers.llm import jaccard
from acctiers.llm import words as W
from acctiers.llm.components import components

from .conftest import ODD, odd_docs, spaced


def brute(rows, n=4, num=85, den=100):
    sets, holders = [], {}
    for i, (_, t) in enumerate(rows):
        w = spaced(t, lower=True)
        sets.append({tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))} if w else set())
        for x in sets[-1]:
            holders.setdefault(x, []).append(i)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j, c in Counter(j for x in s for j in holders[x] if j < i).items():
            if den * c >= num * (len(s) + len(sets[j]) - c):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i), d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


@pytest.mark.parametrize("num", [85, 60])
def test_linked_sets_share_an_index_entry(num):
    rng = np.random.default_rng(num)
    linked = 0
    for _ in range(600):
        s = int(np.exp(rng.uniform(0, 8))) + 1
        common = rng.integers(0, 2**63, s).astype(np.uint64)
        change = int(s * (1 - num / 100) * rng.random())
        a, b = np.unique(common), np.unique(np.concatenate([common[int(rng.integers(0, change + 1)) :], rng.integers(0, 2**63, change).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < num * (len(a) + len(b) - both):
            continue
        linked += 1
        sets = jaccard.Sets(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), np.array([len(a), len(b)]))
        doc, key, least = jaccard.index_entries(sets, num, 100)
        large = int(np.argmax(sets.sizes))
        own = set(key[(doc == large) & (least > 0)].tolist())
        assert len(own & set(key[doc != large].tolist())) >= least[doc == large].max() >= 1
        one, two = jaccard.odd_sketch(sets)
        assert np.bitwise_count(one ^ two).sum() <= len(a) + len(b) - 2 * both
    assert linked > 200


def test_documents_against_brute_force(spark, documents, small_docs):
    assert got(jaccard.linked_components(documents)) == brute(small_docs)


def test_odd_rows(spark):
    assert got(jaccard.linked_components(odd_docs(spark))) == brute(ODD)


@pytest.mark.parametrize("full", [0.0, 3.0])
def test_chains_of_near_copies(spark, monkeypatch, full):
    """Neighbours in a chain link, its ends do not; sets of many sizes, far more than the hubs compared."""
    monkeypatch.setattr(jaccard, "FULL_PAIRS", full)
    rng = np.random.default_rng(3)
    rows = []
    for group in range(6):
        words = [f"g{group}w{i}" for i in range(8 * 2**group)]
        for step in range(12):
            rows.append((len(rows) * 7 % 1009, " ".join(words)))
            at = int(rng.integers(0, len(words)))
            words = [*words[:at], f"new{group}x{step}", *words[at + 1 :]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(jaccard.linked_components(df)) == brute(rows)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(500, 499), (7, 7)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {i: 1 for i in range(2, 41)} | {i: 100 for i in range(101, 130)} | {500: 499}


def test_null_id_before_its_copy(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (1, text), (2, text + " tail")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert got(jaccard.linked_components(docs)) == brute(rows)


def test_empty_table(spark, documents):
    assert jaccard.linked_components(documents.limit(0)).count() == 0


def test_words_of_regular_forms_have_their_own_keys(spark):
    """Thue-Morse words and their complements share every polynomial hash modulo 2**64; their keys differ."""
    pairs = []
    for size in (1024, 4096):
        word = "".join("ab"[bin(i).count("1") % 2] for i in range(size))
        pairs += [word, word.translate(str.maketrans("ab", "ba"))]
    rows = [(i, w) for i, w in enumerate(pairs)]
    found = jaccard.linked_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: i for i in range(len(rows))}


def test_keys_follow_the_word_alone():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abAB") for _ in range(rnd.choice([1, 2, 63, 64, 65, 128, 200]))) for _ in range(400)]
    texts = [" ".join(words), "x " + "  ".join(reversed(words))]
    keys = [W.split(*W.buffers(pa.array([t]))).keys(lower=True) for t in texts]
    assert keys[0].tolist() == keys[1][1:][::-1].tolist()
    assert len(set(keys[0].tolist())) == len({w.lower() for w in words})


def test_large_group_of_near_copies_leaves_few_pairs(spark, monkeypatch):
    """One pair in twenty of a group links: rounds of hubs join it, so few pairs are left for the join of all."""
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(147)]
    rows = []
    for number in range(200):
        at = set(rng.choice(145, 2, replace=False).tolist())
        rows.append((number, " ".join(f"x{rng.integers(10**9)}" if i in at else w for i, w in enumerate(words))))
    pairs, store = [], jaccard.stored

    def counted(df, name):
        out = store(df, name)
        if name == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", counted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(jaccard.linked_components(df)) == brute(rows)
    assert sum(pairs[1:]) <= len(rows) // 10, pairs  # after the first hubs; 173 by the pairs of random hubs and all that were left
