import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from acctiers.llm import ann, quality, toxicity

from .conftest import ODD, odd_docs

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled():
    docs = pq.read_table(f"{DATA}/documents.parquet", columns=["doc_id", "text"])
    rows = docs.join(pq.read_table(f"{DATA}/labels.parquet"), "doc_id", join_type="inner").sort_by("doc_id")
    return rows["text"].combine_chunks(), rows["toxic"].to_numpy(), rows["quality"].to_numpy()


def halves(n):
    test = np.arange(n) % 4 == 0
    return np.flatnonzero(~test), np.flatnonzero(test)


def test_toxicity_on_held_out_texts(labelled):
    texts, toxic, _ = labelled
    fit, test = halves(len(texts))
    model = toxicity.fit(texts.take(pa.array(fit)), toxic[fit], steps=150)
    s = toxicity.sentences(*toxicity.W.buffers(texts.take(pa.array(test))))
    p = toxicity.noisy_or(model.sentence_scores(*model.incidence(s), len(s.doc)), s.doc, len(test))
    assert ((p >= 0.3) == (toxic[test] == 1)).mean() > 0.97


def test_offending_sentences_are_found(spark):
    insult, polite = "You are an idiot today.", "The weather is nice."
    texts = pa.array([f"{polite} {polite} {insult}", polite, f"{polite} {polite}", insult] * 20)
    model = toxicity.fit(texts, np.array([1, 0, 0, 1] * 20), steps=150)
    docs = spark.createDataFrame([(1, f"{polite}\n{insult} {polite}"), (2, None), (3, "")], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    (span,) = rows[1]["offending"]
    assert f"{polite}\n{insult} {polite}"[span["begin"] : span["end"]] == insult[:-1]
    assert rows[1]["score"] > 0.5 and rows[2]["score"] == rows[3]["score"] == 0 and not rows[2]["offending"]


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(13, 1, 5), (1, 0, 5), (4, 0, 5), (9, None, 5)], "doc_id bigint, toxic int, text int")
    model = toxicity.train(odd_docs(spark), labels)
    rows = toxicity.score(odd_docs(spark), model, carry=True).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert rows[0]["carried"]["a.b"] == "dot"
    for kind, want in ((labels.limit(0), 0.0), (labels.where("toxic = 1"), 1.0), (labels.where("toxic = 0"), 0.0)):
        model = toxicity.train(odd_docs(spark), kind)
        score = {r["doc_id"]: r["score"] for r in toxicity.score(odd_docs(spark), model).collect()}
        assert abs(score[1] - want) < 1e-6 and score[4] == 0
    assert toxicity.score(odd_docs(spark).limit(0), model).count() == 0


def test_quality_on_held_out_texts(labelled):
    texts, _, good = labelled
    fit, test = halves(len(texts))
    table = quality.statistics(texts)
    model = quality.fit(table[fit][good[fit] == 1], table)
    assert abs(model.prior - good.mean()) < 0.06
    assert ((model.score(table[test]) >= 0.5) == (good[test] == 1)).mean() > 0.95


def test_quality_of_odd_rows(spark):
    positives = spark.createDataFrame([(1, 3), (2, 3), (404, 3)], "doc_id bigint, text int")
    model = quality.train(odd_docs(spark), positives)
    rows = quality.score(odd_docs(spark), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    neutral = quality.train(odd_docs(spark), positives.limit(0))
    assert all(r["score"] == 0.5 for r in quality.score(odd_docs(spark), neutral).collect())
    assert quality.score(odd_docs(spark).limit(0), model).count() == 0


def exact(rows, k, every):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    size = np.sqrt((x * x).sum(axis=1))
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i] / (size * size[i])
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_recall(spark):
    table = pq.read_table(f"{DATA}/embeddings.parquet")
    rows = list(zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist(), strict=True))
    want = exact(rows, 5, 50)
    got = found(ann.neighbours(spark.read.parquet(f"{DATA}/embeddings.parquet")))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    assert hits >= 0.9 * 5 * len(want)
    scores = {q: dict(w) for q, w in exact(rows, len(rows), 50).items()}
    assert all(abs(scores[q][i] - s) < 1e-12 for q, g in got.items() for i, s in g)


def test_copies_ties_and_odd_vectors(spark, monkeypatch):
    """All leaves opened: the result is exact.  Small blocks split every leaf."""
    monkeypatch.setattr(ann, "BLOCK", 3)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(5)
    good = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else rng.standard_normal(3).tolist()) for i in range(60)]
    bad = [(100, None), (110, [0.0, 0.0, 0.0]), (120, [1.0, None, 2.0]), (130, [float("nan"), 1.0, 1.0]), (140, [1.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in good + bad], "vec_id bigint, embedding array<double>, vector string")
    got = found(ann.neighbours(df, k=5, every=10, trees=2, depth=2, share=1.0))
    want = exact(good, 5, 10)
    assert {q: [i for i, _ in g] for q, g in got.items()} == {q: [i for i, _ in w] for q, w in want.items()}
    few = found(ann.neighbours(df.where("vec_id in (10, 11)"), k=5, every=10))
    assert [i for i, _ in few[10]] == [11]
    assert ann.neighbours(df.limit(0)).count() == 0


def test_extreme_magnitudes_and_repeated_ids(spark):
    """Squares that overflow or vanish leave cosines as they are; a repeated row counts once."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((40, 2))
    size = [1.0, 1e200, 1e-200, 1e-300, 1e300]
    rows = [(i, (v * size[i % 5]).tolist()) for i, v in enumerate(base)]
    df = spark.createDataFrame([*rows, *rows[:7]], "vec_id bigint, embedding array<double>")
    got = found(ann.neighbours(df, k=4, every=10, trees=2, depth=1, share=1.0))
    want = exact([(i, v.tolist()) for i, v in enumerate(base)], 4, 10)
    assert {q: [i for i, _ in g] for q, g in got.items()} == {q: [i for i, _ in w] for q, w in want.items()}
    assert all(abs(a - b) < 1e-12 for q, g in got.items() for (_, a), (_, b) in zip(g, want[q], strict=True))
