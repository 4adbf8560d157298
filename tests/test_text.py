import json

import pytest

from lodestone.operators.text import word_count, word_search
from lodestone.sources.files import read_json_documents, read_lines


def _counts(df):
    return {r.word: r["count"] for r in df.collect()}


def test_word_count_fixture(spark):
    # FIXTURES 2.1: accents split words, digits split, null and empty give nothing
    df = spark.createDataFrame([("Foo, foo  BAR",), ("élève",), ("",), (None,), ("a1b",)], "text string")
    assert _counts(word_count(df)) == {"foo": 2, "bar": 1, "l": 1, "ve": 1, "a": 1, "b": 1}


def test_word_count_additive_under_union(spark):
    a = spark.createDataFrame([("the cat the",), ("dog",)], "text string")
    b = spark.createDataFrame([("The dog!",)], "text string")
    ca, cb, cu = _counts(word_count(a)), _counts(word_count(b)), _counts(word_count(a.union(b)))
    assert cu == {w: ca.get(w, 0) + cb.get(w, 0) for w in set(ca) | set(cb)}


def test_word_count_matches_python(spark):
    import re
    texts = ["Hello, World! hello", "x-y_z 123 abc", "ÀB cd", "  spaced   out  "]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    expect = {}
    for t in texts:
        for w in re.sub("[^a-z]", " ", t.lower()).split(" "):
            if w:
                expect[w] = expect.get(w, 0) + 1
    assert _counts(word_count(df)) == expect


def test_word_search_fixture(spark):
    # FIXTURES 2.2
    df = spark.createDataFrame([(1, "Foo\nbar"), (1, "foo"), (2, None), (3, "food")], "id long, text string")
    assert word_search(df, "foo", per="id").first()["count"] == 1
    assert word_search(df, "foo", per="record").first()["count"] == 2
    assert word_search(df, "zzz").first()["count"] == 0
    assert word_search(df, "FOO").first()["count"] == 1          # argument is lower-cased


def test_word_search_rejects_non_words(spark):
    df = spark.createDataFrame([(1, "a b")], "id long, text string")
    for bad in ["", "a b", "ab1", "é"]:
        with pytest.raises(ValueError):
            word_search(df, bad)


def test_word_search_json_escapes(spark, tmp_path):
    # a JSON array whose text holds an escaped newline: "bar" is its own word
    p = tmp_path / "docs.json"
    p.write_text(json.dumps([{"id": "1", "title": "t", "text": "Foo\nbar"},
                             {"id": "2", "title": "u", "text": "nbar"}], indent=2))
    df = read_json_documents(spark, str(p))
    assert word_search(df, "bar", id_col="id").first()["count"] == 1


def test_word_count_text_lines(spark, tmp_path):
    p = tmp_path / "in.txt"
    p.write_text("one two\nTwo three three\n\n")
    assert _counts(word_count(read_lines(spark, str(p)), "value")) == {"one": 1, "two": 2, "three": 2}


def _py_tokens(t):
    import re
    return [w for w in re.sub("[^a-z]", " ", t.lower()).split(" ") if w]


def test_tokenizer_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    alphabet = st.sampled_from(list("abcXYZ é-1 \n\t.,'Ωß"))

    @settings(max_examples=25, deadline=None)
    @given(st.lists(st.text(alphabet, max_size=40), min_size=1, max_size=6),
           st.sampled_from(["a", "ab", "abc", "x", "zz"]))
    def check(texts, word):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
        expect = {}
        for t in texts:
            for w in _py_tokens(t):
                expect[w] = expect.get(w, 0) + 1
        assert _counts(word_count(df)) == expect
        hits = sum(1 for t in texts if word in _py_tokens(t))
        assert word_search(df, word, id_col="id").first()["count"] == hits
    check()


def test_json_lines_and_top_level_api(spark, tmp_path):
    import lodestone
    p = tmp_path / "docs.jsonl"
    p.write_text('{"id": "1", "title": "a", "text": "Spark and\\nspark"}\n'
                 '{"id": "2", "title": "b", "text": "sparkle"}\n')
    df = lodestone.read_json_documents(spark, str(p), multiline=False)
    assert lodestone.word_search(df, "spark", id_col="id").first()["count"] == 1
    assert {r.word: r["count"] for r in lodestone.word_count(df).collect()}["spark"] == 2


def test_word_search_counts_a_null_id(spark):
    df = spark.createDataFrame([(1, "foo"), (1, "foo bar"), (None, "foo"), (None, "foo"), (2, "x")], "id long, text string")
    assert word_search(df, "foo").first()["count"] == 2
