"""Repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest

from lodestone.llm import substring_automata as S
from lodestone.llm.queries import ORACLE_SQL, QUERIES


def brute(docs, width=13):
    """rows of (doc_id, text) -> (doc_id, n_words, n_removed, sha)."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    ids = [S.LAST if i is None else i for i, _ in docs]
    first = {}
    for i, w in zip(ids, words, strict=True):
        for s in range(len(w) - width + 1):
            k = tuple(w[s:s + width])
            first[k] = min(first.get(k, i), i)
    out = []
    for (name, _), i, w in zip(docs, ids, words, strict=True):
        gone = set()
        for s in range(len(w) - width + 1):
            if first[tuple(w[s:s + width])] < i:
                gone.update(range(s, s + width))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((name, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def got(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def test_automaton_equals_brute_force():
    rng = random.Random(0)
    for _ in range(300):
        width = rng.randint(1, 5)
        texts = [[rng.choice("abc") for _ in range(rng.randint(0, 25))] for _ in range(6)]
        a, held = S.Automaton(), []
        for doc, t in enumerate(texts):
            a.add(t, doc)
            held.append(t)
            below = rng.randint(0, 6)
            q = [rng.choice("abc") for _ in range(30)]
            have = {tuple(x[i:i + width]) for d, x in enumerate(held) if d < below for i in range(len(x) - width + 1)}
            assert a.windows(q, below, width) == [i for i in range(len(q) - width + 1) if tuple(q[i:i + width]) in have]


def corpus(seed, n=150):
    rng = random.Random(seed)

    def fresh(k):
        return [f"w{rng.randint(0, 4000)}" for _ in range(k)]

    shared = [fresh(rng.randint(10, 90)) for _ in range(12)]
    common = fresh(70)
    rows = []
    for i in range(n):
        w = fresh(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randint(0, len(p) - 1)
            w += p[a:rng.randint(a, len(p))] + fresh(rng.randint(0, 4))
        if i % 3 == 0:
            at = rng.randint(0, len(w))
            w[at:at] = common
        rows.append((i * 7 % n, rng.choice([" ", "\n", " \t"]).join(w)))
    rows += [(i + n, rows[5][1]) for i in range(20)]                     # copies
    rows += [(900, "a " * 300), (901, "a " * 12), (902, "a b " * 200), (903, "b a " * 100)]
    return rows


ODD = [(None, "x y " * 40), (None, "x y " * 40), (-5, "x y " * 20), (1, None), (2, ""), (3, " \n"), (8, "é漢 " * 30), (8, "é漢 " * 30),
       (9, "é漢 " * 14 + "end"), (2, "same id other text " * 10), (2, "same id other text " * 9), (11, "q" + " long" * 60000)]


@pytest.mark.parametrize("seed,sample,least", [(1, 64, 8), (2, 1, 8), (3, 1, 2)])
def test_passages_equal_brute_force(spark, seed, sample, least):
    rows = corpus(seed) + ODD
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, rk int, value string")
    assert got(S.removal_digests(df, sample=sample, least=least)) == brute(rows)


def test_hot_windows_are_chosen_and_broadcast(spark):
    rows = S._rows(spark.createDataFrame(corpus(2), "doc_id long, text string"), "doc_id", "text")
    hot, anchors = S._frequent(rows, 13, 5, 1, 8)
    assert len(hot) >= 58 and len(anchors) > 0                           # the 70-word passage of every third row
    automaton = S._hot_automaton(rows, hot, 13, 5)
    assert min(automaton.first) == 0


def test_empty_table_and_texts_out(spark):
    df = spark.createDataFrame([(i, t) for i, t in corpus(4, 30)], "doc_id long, text string")
    assert S.removal_digests(df.limit(0)).count() == 0
    want = brute(corpus(4, 30))
    rows = S.remove_repeats(df).collect()
    assert Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest(), sum(s.end - s.start for s in r.removed)) for r in rows) == \
        Counter({(i, sha, gone): c for (i, _, gone, sha), c in want.items()})


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    ref = con.sql(ORACLE_SQL["op12_substring_automata"])
    assert ref.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = Counter(ref.fetchall())
    assert got(QUERIES["op12_substring_automata"](spark, sf)) == want and sum(r[2] > 0 for r in want) > 50
