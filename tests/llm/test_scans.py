import math

import pytest

from acctiers.llm import decontaminate, licenses, urls

from .conftest import ODD, PASSAGE, SMALL, odd_docs, plain


def brute_hits(rows, items, width=10):
    windows = {}
    for item, text in items:
        w = plain(text)
        if w and item is not None:
            for i in range(max(1, len(w) - width + 1)):
                windows.setdefault(tuple(w[i : i + width]), set()).add(str(item))
    out = []
    for d, t in rows:
        w, hit, found = plain(t), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if d is not None and tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        out.append((d, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


def got_hits(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "item_ids", "contaminated").collect()), key=str)


ITEMS = [(1, PASSAGE), (2, "licensed under cc"), (3, None), (4, ""), (5, "word"), (5, "nice weather"), (None, PASSAGE), (1, PASSAGE), (6, "a " * 15)]


@pytest.mark.parametrize("bound", [0, 200_000])
def test_odd_rows_and_items(spark, monkeypatch, bound):
    """With broadcast tables and without."""
    monkeypatch.setattr(decontaminate, "BROADCAST_TERMS", bound)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert got_hits(decontaminate.contamination(odd_docs(spark), items)) == brute_hits(ODD, ITEMS)


def test_documents_against_brute_force(spark, documents, small_docs):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    rows = [(r["item_id"], r["text"]) for r in items.collect()]
    assert got_hits(decontaminate.contamination(documents, items)) == brute_hits(small_docs, rows)


def test_proximity_match(spark):
    changed = PASSAGE.split()
    changed[5] = "across"
    docs = spark.createDataFrame([(1, " ".join(changed[:10])), (2, f"{PASSAGE.split()[5]} " * 5)], "doc_id bigint, text string")
    items = spark.createDataFrame([(9, " ".join(PASSAGE.split()[:10]))], "item_id bigint, text string")
    row = decontaminate.match_items(docs, items, width=10).collect()
    assert [(r["item_id"], r["start"], r["starts"], r["found"]) for r in row] == [("9", 0, [], 9)]


def brute_near(words, item, width=10, share=0.8):
    """Starts and shifts tried one by one; words of a window in order by dynamic programming."""
    span = min(len(item), width)
    need = max(1, math.ceil(span * share))
    m, best = span - need, 0
    for b in range(-len(item), len(words) + 1):
        for x in range(len(item) - span + 1):
            row = {}
            for at in range(x, x + span):
                at_pos = [b + at + j for j in range(m + 1) if 0 <= b + at + j < len(words) and words[b + at + j] == item[at]]
                for pos in sorted(at_pos, reverse=True):
                    row[pos] = max(row.get(pos, 0), 1 + max((v for q, v in row.items() if q < pos), default=0))
            best = max([best, *row.values()])
    return best if best >= need else 0


def test_proximity_edits(spark):
    """Words without postings, inserted and deleted ones, in short and long items."""
    ten, long = PASSAGE.split()[:10], PASSAGE.split()
    texts = {
        1: [*ten[:5], "across", *ten[6:]],
        2: [*ten[:5], "new", *ten[5:]],
        3: [*ten[:5], *ten[6:]],
        4: ["some", *ten[:3], "x", "y", *ten[3:], "tail"],
        5: [*ten[:3], "p", ten[4], "q", "r", *ten[7:]],
        6: ten[::-1],
        7: [*long[:4], "u", *long[5:9], "v", *long[10:]],
        8: ["q", *long[:2], "r", "s", "t", *long[2:8], "x", "y", "z", *long[12:]],
        9: ["the", "the", "the", "lazy", "dog"] * 4,
        10: ten,
    }
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc_id bigint, text string")
    for item in (ten, long, ten[:5], ten[:1], ["the", "the", "lazy", "lazy", "the"]):
        items = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
        got = {}
        for r in decontaminate.match_items(docs, items).collect():
            got[r["doc_id"]] = max(got.get(r["doc_id"], 0), 99 if r["starts"] else r["found"])
        exact = [d for d, w in texts.items() if brute_hits([(d, " ".join(w))], [(1, " ".join(item))])[0][4]]
        want = {d: 99 if d in exact else brute_near(w, item) for d, w in texts.items()}
        assert got == {d: n for d, n in want.items() if n}
    near = decontaminate.contamination(docs, spark.createDataFrame([(1, " ".join(ten))], "item_id bigint, text string"))
    assert sorted(r["doc_id"] for r in near.where("n_near = 1").collect()) == [1, 2, 3, 4, 7]
    assert [r["doc_id"] for r in near.where("contaminated").collect()] == [10]


def test_empty_tables(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate.contamination(documents.limit(0), items).count() == 0
    none = decontaminate.contamination(documents, items.limit(0))
    assert none.where("contaminated").count() == 0 and none.count() == documents.count()


def brute_base(rows):
    out = []
    for d, t in rows:
        w, at, labels = plain(t), [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            x = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            at += x
            labels |= {label} if x else set()
        out.append((d, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))))
    return sorted(out, key=str)


def base_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()), key=str)


def test_license_base(spark, documents, small_docs):
    assert base_of(licenses.scan(documents)) == brute_base(small_docs)
    assert base_of(licenses.scan(odd_docs(spark))) == brute_base(ODD)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], max(row[j], row[j - 1], before + 1 if x == y else 0)
    return row[-1]


def brute_labels(text, k=4, slack=8, min_share=0.6):
    """(labels, score): votes by diagonal, neighbours merged, spans verified word by word."""
    w, labels, best = plain(text), set(), 0.0
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        if any(w[i : i + len(p)] == p for i in range(len(w))):
            labels.add(label)
            best = 1.0
    places = {}
    for i in range(len(w) - k + 1):
        places.setdefault(tuple(w[i : i + k]), []).append(i)
    for label, family, template in licenses.TEMPLATES:
        t = template.split()
        marks = set(licenses.MARKS.get(family, ()))
        diagonals = sorted({i - at for at in range(len(t) - k + 1) for i in places.get(tuple(t[at : at + k]), ())})
        islands = []
        for d in diagonals:
            if islands and d - islands[-1][-1] <= min(slack, len(t) // 3):
                islands[-1].append(d)
            else:
                islands.append([d])
        for island in islands:
            low, high = island[0], island[-1] + len(t) - 1
            span = w[max(0, low) : high + 1]
            share = lcs(t, span) / max(len(t), high - low + 1)
            if share >= min_share and marks & set(span) == marks & set(t):
                labels.add(label)
                best = max(best, share)
    return ",".join(sorted(labels)), best


def labels_of(df):
    return sorted(((r["doc_id"], r["labels"], round(r["score"], 12)) for r in df.collect()), key=str)


def brute_rows(rows):
    return sorted(((d, (f := brute_labels(t))[0], round(f[1], 12)) for d, t in rows), key=str)


NOTICE = next(" ".join(t.split()) for label, _, t in licenses.TEMPLATES if label == "gpl")
BSD = next(t for label, _, t in licenses.TEMPLATES if label == "bsd")
EDITED = [*BSD.split()[:20], "inserted", "words", *BSD.split()[20:40], *BSD.split()[42:]]
LICENSED = {
    1: (BSD.upper(), "bsd"),
    2: (" ".join(["some", "head", *EDITED, "tail"]), "bsd"),
    3: (" ".join(BSD.split()[: len(BSD.split()) // 3]), ""),
    4: ("nothing at all", ""),
    5: (None, ""),
    6: ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "cc-by-nc-sa"),
    7: ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", "cc-by-nd"),
    8: ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    9: (NOTICE.replace("gnu general", "gnu lesser general"), "lgpl"),
    10: (NOTICE.replace("gnu general", "gnu lesser general", 1), "gpl,lgpl"),  # the base phrase stands in the rest
    11: (NOTICE, "gpl"),
    12: (NOTICE.replace("gnu general", "GNU Affero General"), "agpl"),
    13: ("Licensed under CC BY-NC-SA 4.0", "cc-by,cc-by-nc-sa"),
    14: ("Licensed under CC BY-NC 4.0. Other text follows here.", "cc-by,cc-by-nc"),
    15: ("Licensed under CC BY 4.0; licensed under CC BY-ND 4.0", "cc-by,cc-by-nd"),
    16: ("licensed under cc by nc", "cc-by,cc-by-nc"),
    17: (BSD + " " + " ".join(f"w{i}" for i in range(50)) + " " + BSD, "bsd"),
    None: ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
}


def test_license_families_and_edits(spark):
    """A span must hold the words that tell its template from others of the family; insertions count."""
    rows = [(d, t) for d, (t, _) in LICENSED.items()]
    found = labels_of(licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert {d: labels for d, labels, _ in found} == {d: want for d, (_, want) in LICENSED.items()}
    assert found == brute_rows(rows)


def test_license_labels_against_brute_force(spark, small_docs):
    rows = [*small_docs, *((None, t) for _, t in ODD)]
    assert labels_of(licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string"))) == brute_rows(rows)


def test_repeated_ids_keep_their_own_labels(spark, monkeypatch):
    """Also where the spans are too many to broadcast."""
    monkeypatch.setattr(decontaminate, "BROADCAST_TERMS", 0)
    rows = [(1, LICENSED[6][0]), (1, LICENSED[8][0]), (1, "plain"), (None, NOTICE), (None, "plain")]
    assert labels_of(licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string"))) == brute_rows(rows)


def test_license_empty_table(spark, documents):
    assert licenses.scan(documents.limit(0)).count() == 0


URLS = {
    1: ("https://a.Example.NET/en/x?q=/de/", "a.example.net", "/en/x", "example.net/en/", "allow"),
    2: ("https://example.net/EN/x", "example.net", "/EN/x", "net/", "block"),
    3: ("http://b.example.com/de/1", "b.example.com", "/de/1", "example.com/de/", "block"),
    4: ("http://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
    5: ("http://planet/?a", "planet", "/", None, "allow"),
    6: ("http://net", "net", "", None, "allow"),
    7: (None, "", "", None, "allow"),
    8: ("no scheme casino", "", "", None, "block"),
    9: ("http://x.de/casinos", "x.de", "/casinos", None, "allow"),
    10: ("http://x.de/free/cheap-loan", "x.de", "/free/cheap-loan", None, "block"),
    11: ("http://x.de/free/free#cheap1", "x.de", "/free/free", None, "allow"),
    12: ("://h?x#y", "h", "", None, "allow"),
    13: ("", "", "", None, "allow"),
}


def test_urls(spark):
    pages = spark.createDataFrame([(k, v[0], 1, "v") for k, v in URLS.items()], "page_id bigint, url string, host int, verdict string")
    rows = urls.filter_urls(pages).collect()
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows} == {k: v[1:] for k, v in URLS.items()}
    assert urls.filter_urls(pages.limit(0)).count() == 0
    assert urls.filter_urls(pages.union(pages)).count() == 2 * len(URLS)
