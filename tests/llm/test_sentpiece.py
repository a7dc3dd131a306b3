import itertools
import struct
import zlib
from hashlib import sha256

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from acctiers.llm import sentpiece

from .conftest import ODD, odd_docs

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
OWN = sentpiece.Vocabulary(PATH)
PARTS = ["a", "e", "t", "h", " ", "  ", "▁", "the", "ing", "\n", "\t", "é", "é", "日本", "\U0001f600", "1", "<s>", "</s>", "<0x41>", "\0", " " * 17]


def library(text):
    return LIBRARY.encode(text, add_bos=True, add_eos=True)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(PARTS), max_size=40).map("".join), st.text(max_size=30)), max_size=6))
def test_same_ids_and_texts_as_the_library(texts):
    ids = OWN.encode(pa.array(texts, pa.string()))
    assert ids.to_pylist() == [library(t) for t in texts]
    assert OWN.decode(ids).to_pylist() == [LIBRARY.decode(library(t)) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=12), max_size=6))
def test_any_ids_decode_as_in_the_library(lists):
    assert OWN.decode(pa.array(lists, pa.list_(pa.int32()))).to_pylist() == [LIBRARY.decode(i) for i in lists]


def test_a_control_id_parts_the_bytes_of_a_character():
    """Bytes 0xC2 and 0x80 are one character side by side, none with a control id between them."""
    lists = [[197, 131], [197, 1, 131], [5, 197, 1, 2, 131, 1, 300], [197, 1], [1, 131], [], [300, 1, 301]]
    assert OWN.decode(pa.array(lists, pa.list_(pa.int32()))).to_pylist() == [LIBRARY.decode(i) for i in lists]


@pytest.mark.parametrize("text", ["a" * 6000, " " * 6000 + "x", "ab" * 4000 + " " * 900 + "tail", "日" * 3000, "\U0010ffff" * 500, "word " * 5000])
def test_long_words_and_runs(text):
    assert OWN.encode(pa.array([text, "", text]))[0].as_py() == library(text)


def test_blocks_do_not_change_ids(monkeypatch):
    texts = ["several words in a row", "", "  and   more", "x"]
    whole = OWN.encode(pa.array(texts)).to_pylist()
    monkeypatch.setattr(sentpiece, "BLOCK_CHARS", 3)
    assert OWN.encode(pa.array(texts)).to_pylist() == whole == [library(t) for t in texts]


def test_odd_rows(spark):
    coded = sentpiece.encode(odd_docs(spark), PATH, packed="packed")
    rows = sentpiece.decode(coded, PATH, out_col="again").collect()
    got = sorted(((r["doc_id"], r["ids"], bytes(r["packed"]), r["again"]) for r in rows), key=str)
    want = sorted(((d, (i := library(t or "")), struct.pack(f"<{len(i)}I", *i), LIBRARY.decode(i)) for d, t in ODD), key=str)
    assert got == want
    assert sentpiece.encode(odd_docs(spark, []), PATH).count() == 0


def test_null_and_unknown_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [1, 2])], "doc_id bigint, ids array<int>")
    assert [r["decoded"] for r in sentpiece.decode(rows, PATH).orderBy("doc_id").collect()] == ["", "", ""]
    with pytest.raises(ValueError, match="vocabulary"):
        OWN.decode(pa.array([[40_000]], pa.list_(pa.int32())))


def _field(number, value):
    if isinstance(value, int):
        return bytes([number << 3 & 0x7F | 0x80, number >> 4, value]) if number > 15 else bytes([number << 3, value])
    return bytes([number << 3 | 2, len(value)]) + value


def _model(pieces, **changes):
    """A small model file: pieces as (text, score, type), trainer and normaliser as in the public file."""
    raw = b"".join(_field(1, _field(1, p.encode()) + b"\x15" + struct.pack("<f", s) + _field(3, t)) for p, s, t in pieces)
    trainer = {3: 2, 35: 1} | changes.get("trainer", {})
    normalizer = {3: 1, 4: 0, 5: 1} | changes.get("normalizer", {})
    return raw + b"".join(_field(k, b"".join(_field(n, v) for n, v in spec.items())) for k, spec in ((2, trainer), (3, normalizer)))


SPECIAL = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), *((f"<0x{b:02X}>", 0, 6) for b in range(256))]
SMALL = ["▁", "a", "b", "c", "ab", "bc", "abc", "aa", "aaa", "▁a", "b▁", "ca", "caab"]


@pytest.mark.parametrize("order", [range(13), range(13, 0, -1), [5, 2, 9, 2, 2, 7, 1, 1, 3, 8, 4, 6, 0]])
def test_other_vocabularies(tmp_path, order):
    """Ranks in any order, equal ranks, and a piece across a space: still the library's ids."""
    path = tmp_path / "small.model"
    path.write_bytes(_model([*SPECIAL, *((p, -float(s), 1) for p, s in zip(SMALL, order, strict=True))]))
    theirs, ours = sentencepiece.SentencePieceProcessor(model_file=str(path)), sentpiece.Vocabulary(str(path))
    assert not ours.cut
    texts = ["".join(t) for n in range(8) for t in itertools.product("ab c", repeat=n) if n < 6 or zlib.crc32(repr(t).encode()) % 3 == 0]
    assert ours.encode(pa.array(texts)).to_pylist() == [theirs.encode(t, add_bos=True, add_eos=True) for t in texts]


@pytest.mark.parametrize("changes", [{"trainer": {3: 1}}, {"trainer": {35: 0}}, {"normalizer": {4: 1}}])
def test_other_kinds_of_models_are_refused(tmp_path, changes):
    path = tmp_path / "other.model"
    path.write_bytes(_model([*SPECIAL, ("a", 0, 1)], **changes))
    with pytest.raises(ValueError, match="supported"):
        sentpiece.Vocabulary(str(path))


def test_query_against_the_library(spark, small_docs):
    from acctiers.llm.queries import op13_sentencepiece

    from .conftest import SMALL as FOLDER

    def digest(raw):
        return sha256(raw).hexdigest()

    want = []
    for d, t in small_docs:
        ids = library(t or "")
        want.append((d, len(ids), digest(struct.pack(f"<{len(ids)}I", *ids)), digest(LIBRARY.decode(ids).encode())))
    assert sorted(tuple(r) for r in op13_sentencepiece(spark, FOLDER).collect()) == sorted(want)
