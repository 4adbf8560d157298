from lodestone.operators.primes import parse_integers, top_primes
from lodestone.operators.text import word_count
from lodestone.sources.files import (
    read_csv_ddl, read_lines, read_vectors_csv, write_csv, write_lines, write_tsv)

import pytest


def test_text_to_csv_round_trip(spark, tmp_path):
    src = tmp_path / "words.txt"
    src.write_text("a b a\nc\n")
    out = tmp_path / "out"
    write_csv(word_count(read_lines(spark, str(src)), "value"), str(out))
    back = spark.read.schema("word string, count long").csv(str(out))
    assert sorted(map(tuple, back.collect())) == [("a", 2), ("b", 1), ("c", 1)]


def test_numbers_file_to_lines(spark, tmp_path):
    src = tmp_path / "nums.txt"
    src.write_text("\n".join(["5", "x", "11", "4", "13", "13"]) + "\n")
    nums = parse_integers(read_lines(spark, str(src)), "value", on_error="drop")
    out = tmp_path / "primes"
    write_lines(top_primes(nums, "value", 3), str(out))
    lines = sorted(r.value for r in spark.read.text(str(out)).collect())
    assert lines == ["11", "13", "13"]


def test_tsv_refuses_existing(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v long")
    out = str(tmp_path / "tsv")
    write_tsv(df, out)
    assert spark.read.text(out).first().value == "a\t1"
    with pytest.raises(Exception):
        write_tsv(df, out)


def test_census_csv_trimmed(spark, tmp_path):
    p = tmp_path / "adult.data"
    p.write_text("39, State-gov, 77516, Bachelors, 13, Never-married, Adm-clerical, Not-in-family,"
                 " White, Male, 2174, 0, 40, United-States, <=50K\n")
    row = read_csv_ddl(spark, str(p)).first()
    assert row.age == 39.0 and row.workclass == "State-gov" and row.income == "<=50K"


def test_vectors_csv(spark, tmp_path):
    p = tmp_path / "v.csv"
    p.write_text("1,0,0\n0,1,0\n")
    df = read_vectors_csv(spark, str(p))
    assert sorted(r.vector for r in df.collect()) == [[0.0, 1.0, 0.0], [1.0, 0.0, 0.0]]
    assert df.select("id").distinct().count() == 2


def test_row_ids_do_not_follow_the_splits(spark, tmp_path):
    n = 0
    for name, size in (("b.csv", 3000), ("a.csv", 500), ("c.csv", 1), ("d.csv", 0)):
        (tmp_path / name).write_text("".join(f"{n + i},{i}\n" for i in range(size)))
        n += size
    order = [*range(3000, 3500), *range(3000), 3500]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1024", "5000", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = read_vectors_csv(spark, str(tmp_path), "a double, b double").collect()
            assert [(r.id, r.vector[0]) for r in sorted(rows)] == list(enumerate(map(float, order)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_json_lines_round_trip(spark, tmp_path):
    from lodestone.sources.files import read_json_documents, write_json_lines
    rows = [("1", "t", "two\nlines \"q\" é\u2028"), ("2", None, ""), (None, "x", None)]
    write_json_lines(spark.createDataFrame(rows, "id string, title string, text string"), str(tmp_path / "j"))
    assert sorted(map(repr, read_json_documents(spark, str(tmp_path / "j"), multiline=False).collect())) == \
        sorted(map(repr, spark.createDataFrame(rows, "id string, title string, text string").collect()))


def test_csv_vectors_to_kmedoids_report(spark, tmp_path):
    # the reference's clustering program: numeric CSV -> vectors -> loop -> 4-line report
    from lodestone.operators.kmedoids import k_medoids
    rows = ["1,0,0", "0.9,0.1,0", "0.8,0.3,0", "0,1,0", "0.1,0.9,0", "0.3,0.8,0", "0,0,1", "0,0.1,0.9"]
    p = tmp_path / "samples.csv"
    p.write_text("\n".join(rows) + "\n")
    vecs = read_vectors_csv(spark, str(p), schema="a double, b double, c double")
    res = k_medoids(vecs, "id", "vector", 3, "improved", max_iter=10)
    assert res.assignments.count() == len(rows)
    assert res.medoids.count() == 3
    out = str(tmp_path / "report")
    write_lines(res.report(), out)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert len(lines) == 4 and lines[0].startswith("Time: ") and lines[3].startswith("Final cost: ")
