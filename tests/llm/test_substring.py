import random

import numpy as np
import pytest

from acctiers.llm import substring
from acctiers.llm.fmindex import FMIndex, WaveletMatrix

from .conftest import ODD, odd_docs, spaced

WIDTH = 13


def brute(rows, width=WIDTH):
    first = {}
    for d, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = spaced(t)
        for i in range(len(w) - width + 1):
            first.setdefault(tuple(w[i : i + width]), d)
    out = []
    for d, t in rows:
        w = spaced(t)
        gone = set()
        for i in range(len(w) - width + 1):
            if d is not None and first[tuple(w[i : i + width])] < d:
                gone.update(range(i, i + width))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept").collect()), key=str)


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 37, 1000)
    tree = WaveletMatrix(x, 36)
    at = rng.integers(0, 1001, 300)
    symbols = rng.integers(0, 37, 300)
    ranks = tree.descend(symbols, at) - tree.descend(symbols, np.zeros(300, int))
    assert ranks.tolist() == [int((x[:i] == s).sum()) for s, i in zip(symbols, at, strict=True)]


@pytest.mark.parametrize("depth", [2, 5, 13])
def test_matching_statistics(depth):
    rng = random.Random(depth)
    for _ in range(15):
        sequences = [[rng.randint(2, 5) for _ in range(rng.randint(1, 30))] for _ in range(rng.randint(1, 8))]
        whole = [x for s in sequences for x in (*s, FMIndex.SEPARATOR)]
        index = FMIndex(np.array(whole), depth)
        patterns = [[rng.randint(2, 7) for _ in range(rng.randint(1, 25))] for _ in range(8)] + sequences[:2]
        found, rank = index.matching_statistics(
            np.array([x for p in patterns for x in p]), np.array([len(p) for p in patterns])
        )
        k = 0
        for p in patterns:
            for i in range(len(p)):
                longest = max(
                    n for n in range(depth + 1) if n == 0 or any(p[i : i + n] == s[j : j + n] for s in sequences for j in range(len(s) - n + 1)) and i + n <= len(p)
                )
                assert found[k] == longest
                if longest:
                    at = index.suffixes[rank[k]]
                    assert whole[at : at + longest] == p[i : i + longest]
                k += 1


def test_documents_against_brute_force(spark, documents, small_docs):
    assert got(substring.remove_repeats(documents, WIDTH)) == brute(small_docs)


@pytest.mark.parametrize("hot", [0, 5_000])
def test_odd_rows(spark, monkeypatch, hot):
    """Null, empty, long, repeated rows and clashing columns; with every anchor hot, and with none."""
    monkeypatch.setattr(substring, "HOT_ANCHOR", hot)
    assert got(substring.remove_repeats(odd_docs(spark), WIDTH)) == brute(ODD)


def test_unchanged_texts_and_carried_columns(spark):
    df = substring.remove_repeats(odd_docs(spark), WIDTH, respace=False, carry=["id2", "a.b", "carried"])
    rows = {r["carried"]["id2"]: r for r in df.collect()}
    for i, (_, text) in enumerate(ODD):
        if not rows[i]["n_removed"]:
            assert rows[i]["kept"] == (text or "")
        assert rows[i]["carried"]["a.b"] == "dot"


def test_empty_table(spark, documents):
    assert substring.remove_repeats(documents.limit(0), WIDTH).count() == 0
