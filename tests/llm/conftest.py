import os
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest

REPO = Path(__file__).resolve().parents[2]
# Python workers import the package, too
os.environ["PYTHONPATH"] = f"{REPO}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def spaced(text, lower=False):
    text = text or ""
    return SPACED.findall(text.translate(LOWER) if lower else text)


def plain(text):
    return PLAIN.findall((text or "").translate(LOWER))


SMALL = "/root/testdata/sf0.001"

# ids, texts: null, empty, blank, repeated rows, one word, a long text of few words, ties, odd characters
LONG = " ".join(f"w{i % 97}" for i in range(30_000))
PASSAGE = "the quick brown fox jumps over the lazy dog while seven other animals watch from afar today"
ODD = [
    (1, PASSAGE + " first tail of its own"),
    (2, "head of its own " + PASSAGE),
    (3, None),
    (4, ""),
    (5, " \t\n\r\x0b\x0c "),
    (6, "word"),
    (7, PASSAGE),
    (8, PASSAGE),
    (8, PASSAGE),
    (9, LONG),
    (10, LONG + " end"),
    (11, "a a a a a a a a a a a a a a a a a a a a a a"),
    (12, "A B été \u0001\u007f \U0001f600 café Licensed under CC BY-NC 4.0 and the MIT License."),
    (13, "you are an idiot. Nice weather."),
    (None, PASSAGE),
]
EXTRA = "id2 bigint, doc_id bigint, text string, words int, carried string, key string, `class` string, `a.b` string, kept_id int"


def odd_docs(spark, rows=ODD):
    full = [(i, d, t, 1, "c", "k", None, "dot", 0) for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(full, EXTRA)


@pytest.fixture(scope="session")
def small_docs():
    table = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
