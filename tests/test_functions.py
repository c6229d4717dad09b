"""Functions on single values, with the edge cases that their docstrings name."""

import pytest
from pyspark.sql import functions as F

from lensgrove import functions as L
from lensgrove.functions.arrays import colours_text


def values(spark, kind, inputs, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r["o"] for r in rows.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_lenient_int(spark):
    texts = ["12", "3.7", "2.5", "-2.5", "1e3", "", " 7 ", "x", None, "99999999999", "nan", ".5", "+4"]
    assert values(spark, "string", texts, L.lenient_int) == [12, 4, 3, -3, 1000, None, 7, None, None, None, None, 1, 4]
    assert values(spark, "string", ["99999999999"], lambda c: L.lenient_int(c, "bigint")) == [99999999999]


def test_to_long(spark):
    assert values(spark, "string", ["12", "12.0", "1e3", "12.5", "", "x", None, " 7 "], L.to_long) == [12, 12, 1000, None, None, None, None, 7]


def test_lenient_float(spark):
    assert values(spark, "string", ["43.1", "", "x", None], L.lenient_float) == [pytest.approx(43.1, rel=1e-6), None, None, None]


@pytest.mark.parametrize(
    ("url", "ext"),
    [
        ("http://h/a/b.JPG?x=.png", "jpg"),
        ("http://h.png", None),
        ("http://h/a.b/c", None),
        ("/x/y.jpeg#z", "jpeg"),
        ("http://h/a b.gif", "gif"),
        ("http://h/a.tiff", None),
        (None, None),
        ("", None),
    ],
)
def test_url_ext(spark, url, ext):
    assert values(spark, "string", [url], L.url_ext) == [ext]


def test_storage_ext(spark):
    assert values(spark, "string", ["h/a.PNG?b.jpg", "h/a.gif", None, "h/.png", "h/a"], L.storage_ext) == ["png", "jpg", "jpg", "jpg", "jpg"]
    assert values(spark, "string", ["..JPEG", "gif", None], L.value_ext) == ["jpeg", "jpg", "jpg"]


def test_best_url(spark):
    rows = spark.createDataFrame(
        [(7, "png", "o", "u"), (0, "png", "o", "u"), (None, "png", "", "http://h/medium.jpg"), (7, "", None, "http://h/large.jpg/square.x/square.y"), (7, None, "", ""), (None, None, None, None)],
        "id bigint, ext string, o string, u string",
    )
    got = [r[0] for r in rows.select(L.best_url(F.col("id"), F.col("ext"), F.col("o"), F.col("u"), "http://s")).collect()]
    assert got == ["http://s/7/original.png", "o", "http://h/original.jpg", "http://h/large.jpg/original.x/original.y", None, None]


def test_sanitize_and_binomial(spark):
    assert values(spark, "string", [" a b\tc ", "é-x", None, ""], L.sanitize) == ["a_b_c", "x", "", ""]
    names = ["quercus ALBA x", "Quercus × alvordiana", "  ", None, "McX", "a b"]
    assert values(spark, "string", names, L.binomial) == ["Quercus_alba", "Quercus_", "Unknown_unknown", "Unknown_unknown", "McX", "A_b"]


def test_batch_names_keep_all_digits(spark):
    assert values(spark, "bigint", [1, 10_000, 10_001, 10**10], L.batch_name) == ["batch_00001", "batch_00001", "batch_00002", "batch_1000000"]


def test_scores_round_exactly(spark):
    assert values(spark, "double", [0.90625, 0.93595, 0.5], L.score_text) == ["0.9062", "0.9360" if round(0.93595, 4) == 0.936 else "0.9359", "0.5000"]


def test_lists(spark):
    assert values(spark, "string", ["1, 2,,3", ""], L.int_list) == [[1, 2, 3], []]
    rows = spark.sql("select array(named_struct('score', 0.5D, 'k', 1), named_struct('score', 0.9D, 'k', 2), named_struct('score', 0.5D, 'k', 3)) as a")
    assert [x["k"] for x in rows.select(L.sort_instances(F.col("a")).alias("s")).first()["s"]] == [2, 1, 3]
    assert [x["k"] for x in rows.select(L.top_scores(F.col("a"), 0.9).alias("s")).first()["s"]] == [2]
    colours = spark.sql("select array(named_struct('r', 1, 'g', 2, 'b', 3), null) as c")
    assert colours.select(colours_text(F.col("c"))).first()[0] == "(1,2,3)"


def test_tails(spark):
    assert values(spark, "string", ["a\nb\nc\n", "a"], lambda c: L.tail_lines(c, 2)) == ["b\nc", "a"]
    assert values(spark, "string", ["abc"], lambda c: L.tail_chars(c, 2)) == ["bc"]
