import base64
import hashlib
import itertools
import random

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from acctiers.llm import bpe, counts
from acctiers.llm.pieces import find_all

from .conftest import ODD, odd_docs

RANKS, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def pairs():
    return bpe.BytePairs(bpe.read_ranks(RANKS))


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(4)
    points = [*range(0x250), 0x3A3, 0x3C3, 0x301, 0x130, 0x2028, 0x3000, 0x1F600, 0x4E2D, 0x1D7CE, 0xBD, 0x2160, 0xFB01]
    out = ["".join(chr(rng.choice(points)) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    out += ["".join(rng.choice(" \n\t'stdaeix're  re") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    return out + ["a" * 3000, " " * 4000 + "x", "", "hi <|endoftext|> wor<|startoftext|>ld <|END", "ΑΣ Σ"]


def test_ids_are_the_librarys(pairs, library):
    for t in texts():
        assert [i for p in find_all(public_tokenizers.PATTERN, t) for i in pairs.encode(p.encode())] == library.encode_ordinary(t)


def test_counts_are_the_librarys():
    merges, tokenizer = counts.Merges(WORDS), Tokenizer.from_file(WORDS)
    import re

    marks = re.compile("|".join(map(re.escape, merges.special)))
    for t in texts():
        parts = marks.split(t)
        mine = len(parts) - 1 + sum(merges.count(p.encode()) for x in parts for p in find_all(merges.pattern, counts.lowered(x)))
        assert mine == len(tokenizer.encode(t, add_special_tokens=False).ids)


def test_appends_and_edits(pairs):
    rng = random.Random(2)
    whole = bpe.PrefixEncoder(pairs)
    data = b""
    for _ in range(60):
        more = bytes(rng.choice(b"the andstion ing") for _ in range(rng.randint(0, 9)))
        data += more
        whole.append(more)
        assert whole.ids() == bpe.PrefixEncoder(pairs, data).ids()
    for _ in range(60):
        a = rng.randint(0, len(data))
        b = rng.randint(a, min(len(data), a + 6))
        new = bytes(rng.choice(b"the andstion") for _ in range(rng.randint(0, 5)))
        data = data[:a] + new + data[b:]
        whole.replace(a, b, new)
        assert whole.data == data and whole.ids() == bpe.PrefixEncoder(pairs, data).ids()


def test_edit_stops_where_the_table_agrees(pairs):
    text = b" hello world of many words" * 100
    encoder = bpe.PrefixEncoder(pairs, text)
    assert encoder.replace(30, 33, b"xyz") < 400
    assert encoder.ids() == bpe.PrefixEncoder(pairs, text[:30] + b"xyz" + text[33:]).ids()


def test_round_trip_of_odd_rows(spark, library):
    coded = bpe.decode(bpe.encode(odd_docs(spark), RANKS, public_tokenizers.PATTERN, keep_text=True), RANKS)
    rows = coded.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert bytes(r["decoded"]) == r["text"].encode()
        assert r["ids"] == library.encode_ordinary(r["text"])


def test_counts_of_odd_rows(spark):
    tokenizer = Tokenizer.from_file(WORDS)
    want = sorted((str(d), len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for d, t in ODD)
    rows = counts.count_tokens(odd_docs(spark), WORDS, limit=100).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in rows) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in rows)


def test_empty_tables(spark, documents):
    none = documents.limit(0)
    assert counts.count_tokens(none, WORDS).count() == 0
    assert bpe.decode(bpe.encode(none, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_query_digests(spark, documents, small_docs, library):
    from acctiers.llm.queries import op2_byte_bpe

    rows = {r["doc_id"]: r for r in op2_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    for d, t in small_docs:
        ids = library.encode_ordinary(t or "")
        assert rows[d]["n_tokens"] == len(ids)
        assert rows[d]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[d]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_a_prefix_asks_for_each_part_once():
    """The last token of a prefix costs one look-up per part, also where the part is a token."""

    class Counted(dict):
        asked = 0

        def __contains__(self, key):
            Counted.asked += 1
            return super().__contains__(key)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

        def get(self, key, default=None):
            Counted.asked += 1
            return super().get(key, default)

    pairs = bpe.BytePairs([b"a", b"b", b"c", b"ab", b"abc"])
    pairs.ids = Counted(pairs.ids)
    assert pairs.last_token(b"abc", 3, [-1, 0, 3]) == 4
    assert Counted.asked == 1


def test_pieces_that_begin_alike_share_their_prefixes(monkeypatch):
    """Same ids as without shared heads, with fewer prefixes worked out; tokens of every length, heads thrown away in between."""
    tokens = [bytes([c]) for c in b"abc"] + [b"ab", b"bc", b"ca", b"abc", b"cab", b"abcab", b"bcabca", b"abcabcab"]
    monkeypatch.setattr(bpe, "CACHED_HEADS", 50)
    pieces = [bytes(p) for n in range(1, 10) for p in itertools.product(b"abc", repeat=n) if n < 7 or p[:6] == tuple(b"abcabc")]
    want = [bpe.PrefixEncoder(bpe.BytePairs(tokens), p).ids() for p in pieces]
    pairs, calls = bpe.BytePairs(tokens), []
    plain = pairs.last_token
    monkeypatch.setattr(pairs, "last_token", lambda *a: calls.append(1) or plain(*a))
    ids = [pairs.ids.get(p) for p in pieces]
    assert [pairs.encode(p) for p in pieces] == [(i,) if i is not None else w for i, w in zip(ids, want, strict=True)]
    assert len(calls) < sum(map(len, pieces)) / 2 and len(pairs._heads) <= 50
