"""Near-duplicate classes against brute force over all pairs."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lodestone.llm.common import TextBytes
from lodestone.llm.components import _star, components
from lodestone.llm.probminhash import (BANDS, ROWS, near_duplicates, prob_min_hash, probability_jaccard,
                                       shingles, verified)
from lodestone.sources.tables import table


def weights(text):
    w = (text or "").encode().split()
    if not w:
        return Counter()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def similarity(x, y):
    """The definition: sum over shared d of 1 / sum over e of max(x_e/x_d, y_e/y_d)."""
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())


def brute_classes(rows, threshold=0.8):
    ids = [i for i, _ in rows]
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ws = {i: weights(t) for i, t in rows}
    by_shingle = {}
    for i in ids:
        for s in ws[i]:
            by_shingle.setdefault(s, set()).add(i)
    seen = set()
    for group in by_shingle.values():
        g = sorted(group)
        for k, i in enumerate(g):
            for j in g[k + 1:]:
                if (i, j) in seen:
                    continue
                seen.add((i, j))
                if ws[i] == ws[j] or similarity(ws[i], ws[j]) >= threshold:
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    return {i: root(i) for i in ids}


def test_register_agreement_estimates_probability_jaccard():
    a = " ".join(f"w{i}" for i in range(60)) + " tail" * 9
    b = " ".join(f"w{i}" for i in range(50)) + " tail" * 6
    t = TextBytes(pa.array([a, b]))
    z = prob_min_hash(*shingles(t), 2, 4000)
    expect = similarity(weights(a), weights(b))
    assert abs((z[0] == z[1]).mean() - expect) < 0.04
    row, h, c = shingles(t)
    assert probability_jaccard(h[row == 0], c[row == 0], h[row == 1], c[row == 1]) == pytest.approx(expect)


def test_documents_match_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    assert got == brute_classes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_edge_cases_and_groups(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 5000, 120)]
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "a b"), (4, "a  b"), (5, "a b c"), (6, " ".join(base))]
    for i in range(7, 47):                       # a group of near copies, each with one changed word
        w = list(base)
        w[int(rng.integers(0, 120))] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(50, " ".join(f"q{i}" for i in range(30000))), (51, " ".join(f"q{i}" for i in range(30000)) + " end"),
             (50, " ".join(f"q{i}" for i in range(30000)))]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows] + [(None, "a b", 2, "y")],
                               "doc_id long, text string, id int, bucket string")
    out = near_duplicates(df).collect()
    assert len(out) == len(rows) + 1
    got = {r.doc_id: r.class_id for r in out}
    assert got.pop(None) is None
    assert got == {**{i: i for i in (0, 1, 2)}, 3: 3, 4: 3, 5: 5, **{i: 6 for i in range(6, 47)}, 50: 50, 51: 50}
    assert near_duplicates(df.limit(0)).count() == 0
    assert BANDS * ROWS == 125


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(5, 5), (None, 3)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def test_a_star_round_reads_its_edges_once_a_use(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2), (9, 4)], "u long, v long")
    plan = _star(_star(edges, True), False)
    assert sorted(map(tuple, plan.collect())) == [(2, 1), (3, 1), (9, 4)]
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD") + text.count("LocalRelation") <= 4         # 16 with unions of both directions


def test_pairs_to_verify_are_found_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    words = [f"w{i}" for i in range(40)]
    texts = spark.createDataFrame([(i, " ".join([*words, f"x{i}"])) for i in range(6)] + [(9, "other")], "id long, text string")
    pairs = spark.createDataFrame([(0, i) for i in (1, 2, 3, 4, 5, 9)], "a long, b long").mapInArrow(counted, "a long, b long")
    assert sorted(map(tuple, verified(pairs, texts, 0.8).collect())) == [(0, i) for i in range(1, 6)]
    assert seen.value == 6


def classes(spark, rows):
    return {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def two_groups(n_short, n_long):
    """Beginnings of one text in two groups, similar within and under 0.8 between them, and one
    document beside each group; the two are similar (1599 of 1998 shingles), to nothing else across."""
    w = [f"w{i}" for i in range(2010)]
    return ([(i, " ".join([*w[:1600], f"x{i}"])) for i in range(n_short)]
            + [(1000 + i, " ".join([*w, f"y{i}"])) for i in range(n_long)]
            + [(5000, " ".join(w[:1603])), (5001, " ".join(w[:2002]))])


def test_hot_bucket_joined_by_common_shingles(spark):
    rows = two_groups(400, 100)          # the three shingles beyond the first group are in 102 documents
    assert classes(spark, rows) == {i: 0 for i, _ in rows}


def test_hot_bucket_of_shortened_copies(spark):
    rows = two_groups(100, 400)          # the second group has all shingles of the first
    assert classes(spark, rows) == {i: 0 for i, _ in rows}


def test_classes_do_not_depend_on_other_documents(spark):
    w = [f"w{i}" for i in range(1000)]
    copies = [(i, " ".join([*w[:9 + 3 * i], f"x{i}", *w[10 + 3 * i:]])) for i in range(300)]
    parts = [(1000 + n, " ".join(w[:n])) for n in range(300, 790, 3)]
    others = [(10000 + 5 * g + k, " ".join([f"g{g}_{i}" for i in range(50)] + [f"e{g}_{k}_{i}" for i in range(8)]))
              for g in range(800) for k in range(5)]                       # look-alikes at 46 of 62
    want = {i: 0 for i, _ in copies} | {i: 1300 for i, _ in parts}
    got = classes(spark, copies + parts + others)
    assert got == want | {i: i for i, _ in others}
