import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kithwork import sources
from kithwork.functions import split_fields
from kithwork.operators import words


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def split(spark, value, sep):
    return lines(spark, value).select(split_fields(F.col("value"), sep)).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [("a  b ", ["a", "", "b"]), ("", [""]), ("   ", []), (" a", ["", "a"]), ("a\tb c,", ["a\tb", "c,"])],
)
def test_words_keep_inner_and_leading_empty_fields_only(spark, text, expected):
    assert split(spark, text, " ") == expected


@pytest.mark.parametrize(
    "text, sep, expected",
    [("1::x::", "::", ["1", "x"]), ("::", "::", []), ("a:b::c", "::", ["a:b", "c"]), ("A|B|", "|", ["A", "B"]), ("||", "|", [])],
)
def test_split_on_other_separators(spark, text, sep, expected):
    assert split(spark, text, sep) == expected


def test_word_count(spark):
    counts = dict(words.word_count(lines(spark, "a  b ", "", "   ", " a", "A a.")).collect())
    assert counts == {"a": 2, "b": 1, "": 3, "A": 1, "a.": 1}


def test_adjacency_edges_and_rejects(spark):
    raw = lines(spark, "5\t2,3,4", "7\t", "7", "8\t8,9,9", "x\t1", "9\t1,y", "")
    edges = sorted(map(tuple, sources.adjacency_edges(raw).collect()))
    assert edges == [(5, 2), (5, 3), (5, 4), (8, 8), (8, 9), (8, 9), (9, 1)]
    rejected = [r.value for r in sources.rejected_lines(raw, "adjacency").collect()]
    assert sorted(rejected) == ["", "9\t1,y", "x\t1"]


def test_profiles(spark):
    raw = lines(
        spark, "3,Ann,Lee,1 Main,Town,TX,00123,,,8/15/1990", "4,Bob,Ray,2 Main,Town,TX,75080,u,v,8-15-1990", "5,short"
    )
    rows = sorted(map(tuple, sources.parse_profiles(raw).collect()))
    assert rows == [
        (3, "Ann", "Lee", "1 Main", "Town", "TX", "00123", "8/15/1990", 8, 1990),
        (4, "Bob", "Ray", "2 Main", "Town", "TX", "75080", "8-15-1990", None, None),
        (5, "short", None, None, None, None, None, None, None, None),
    ]
    assert sources.rejected_lines(raw, "profiles").count() == 2


def test_labeled(spark):
    raw = lines(spark, "1,1.5,2,7", "2,x,2,7", "3,4")
    assert [tuple(r) for r in sources.parse_labeled(raw).collect()] == [(1, 7.0, [1.5, 2.0]), (3, 4.0, [])]
    assert [r.value for r in sources.rejected_lines(raw, "labeled").collect()] == ["2,x,2,7"]


def test_delimited_keeps_quotes_and_short_rows(spark, tmp_path):
    path = str(tmp_path / "movies")
    lines(spark, '1::Toy "Story::A|B', "3::Short", "x::Bad::Z", "4::back\\slash::C::extra").write.text(path)
    rows = {r.title: (r.item_id, r.genres) for r in sources.read_delimited(spark, path, sources.MOVIES).collect()}
    assert rows == {'Toy "Story': (1, "A|B"), "Short": (3, None), "Bad": (None, "Z"), "back\\slash": (4, "C")}
    parsed = sources.parse_movies(sources.read_lines(spark, path))
    assert {r.item_id for r in parsed.collect()} == {1, 3, 4}


def test_single_colon_shifts_a_title_with_a_colon(spark, tmp_path):
    path = str(tmp_path / "movies")
    lines(spark, "1:Alien: Again:Action").write.text(path)
    assert tuple(sources.read_delimited(spark, path, sources.MOVIES, ":").first()) == (1, "Alien", " Again")


def test_delimited_scan_reads_only_asked_columns(spark, tmp_path):
    path = str(tmp_path / "ratings")
    lines(spark, "1::2::3::9").write.text(path)
    df = sources.read_delimited(spark, path, sources.RATINGS).select("item_id")
    assert "ReadSchema: struct<item_id:bigint>" in df._jdf.queryExecution().executedPlan().toString()


def test_write_text_modes_and_styles(spark, tmp_path):
    path = str(tmp_path / "out")
    pairs = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int")
    sources.write_text(pairs, path, mode="errorifexists")
    assert sorted(r.value for r in sources.read_lines(spark, path).collect()) == ["a\t1", "b\t"]
    with pytest.raises(AnalysisException):
        sources.write_text(pairs, path, mode="errorifexists")
    sources.write_text(pairs.limit(1), path, style="tuple")
    assert [r.value for r in sources.read_lines(spark, path).collect()] == ["(a,1)"]


def test_delimited_scan_takes_wide_ids(spark, tmp_path):
    path = str(tmp_path / "wide")
    lines(spark, "3000000000::7::5::0", "1::2::3::9").write.text(path)
    rows = sources.read_delimited(spark, path, sources.RATINGS).orderBy("user_id").collect()
    assert [tuple(r) for r in rows] == [(1, 2, 3, "9"), (3_000_000_000, 7, 5, "0")]
