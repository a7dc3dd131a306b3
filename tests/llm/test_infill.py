import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from acctiers.llm import infill

from .conftest import ODD, odd_docs

MARKS = ("<P>", "<S>", "<M>")


def digest(text):
    return sha256(text.encode()).hexdigest()


def brute(d, text, seed=1, arranged=90, suffix_first=20):
    text = text or ""
    n = len(text)
    h = [int(sha256(f"{seed}:{d}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if d is None or not text or any(m in text for m in MARKS) or h[2] % 100 >= arranged:
        return d, n, "plain", None, None, text
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h[3] % 100 < suffix_first:
        return d, n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return d, n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,arranged,suffix_first", [(1, 90, 20), (7, 100, 50), (3, 0, 20), (5, 100, 100)])
def test_odd_rows(spark, seed, arranged, suffix_first):
    rows = [*ODD, (20, "holds <P> itself"), (21, "<M>"), (22, "ends in <"), (23, "<S"), (24, "é日\U0001f600" * 50)]
    made = infill.transform(odd_docs(spark, rows), seed, arranged, suffix_first, digest="sha")
    back = infill.restore(made, text="again", digest="sha_again")
    want = sorted(((w := brute(d, t, seed, arranged, suffix_first)) + (digest(w[5]), t or "", digest(t or "")) for d, t in rows), key=str)
    assert found(back) == want


def test_sentinel_like_texts():
    """Random texts of sentinel characters: every form, cut and hash as by plain string work."""
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab<>SPMé日\U0001f600 ") for _ in range(rnd.randrange(40))) for _ in range(3000)]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    n, low, high, form = infill._chosen(batch, 1, 90, 20)
    table = infill.arrange(batch["text"], low, high, form)
    outputs = table.texts().to_pylist()
    want = [brute(d, t) for d, t in enumerate(texts)]
    assert [infill.FORMS[f] for f in form] == [w[2] for w in want] and outputs == [w[5] for w in want]
    assert table.hashes() == [digest(o) for o in outputs]
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    back = infill.restore_pieces(pa.array(outputs), form)
    assert back.texts().to_pylist() == texts and back.hashes() == [digest(t) for t in texts]


def test_no_bytes_are_copied_before_writing():
    """Cutting and arranging leave both buffers as they are; descriptors point into them."""
    texts = pa.array(["one text", "another"])
    table = infill.arrange(texts, np.array([2, 0]), np.array([5, 7]), np.array([1, 2]))
    assert table.buffers[infill.TEXT].tobytes() == b"one textanother" and table.buffers[infill.MARK].tobytes() == b"<P><S><M>"
    assert table.texts().to_pylist() == ["<P>on<S>ext<M>e t", "<S><P><M>another"] and len(table.row) == 12


def test_outputs_without_their_sentinels_are_refused():
    with pytest.raises(ValueError, match="sentinel"):
        infill.restore_pieces(pa.array(["<P>a<S>b"]), np.array([1]))


def test_empty_table_and_query(spark, small_docs):
    from acctiers.llm.queries import op12_fill_in_middle

    from .conftest import SMALL

    assert infill.restore(infill.transform(odd_docs(spark, []))).count() == 0
    want = sorted(((w := brute(d, t))[:5] + (digest(w[5]), digest(t or "")) for d, t in small_docs), key=str)
    assert found(op12_fill_in_middle(spark, SMALL)) == want
