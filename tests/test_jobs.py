"""Whole jobs from text files to text files."""

import pytest

from kithwork import sources
from kithwork.plans import jobs


@pytest.fixture
def files(spark, tmp_path):
    def write(name, *values):
        path = str(tmp_path / name)
        spark.createDataFrame([(v,) for v in values], "value string").write.text(path)
        return path

    return write


@pytest.fixture
def graph_files(files):
    adjacency = files("adj", "1\t2,3,4", "2\t1,3,5", "3\t1,2,5", "4\t1", "5\t2,3", "6\t", "7")
    people = files(
        "people",
        *(f"{u},N{u},L{u},{u} Main,Town,TX,0{u}000,,,{u}/1/{1950 + u}" for u in (1, 2, 3, 4, 5)),
    )
    return adjacency, people


def read(spark, path):
    return sorted(r.value for r in sources.read_lines(spark, path).collect())


def test_word_count(spark, files, tmp_path):
    out = str(tmp_path / "out")
    jobs.word_count(spark, files("text", "a b", "a"), out)
    assert read(spark, out) == ["a\t2", "b\t1"]
    with pytest.raises(Exception):
        jobs.word_count(spark, files("again", "c"), out)
    jobs.word_count(spark, files("more", "c"), out, mode="overwrite", style="tuple")
    assert read(spark, out) == ["(c,1)"]


def test_friend_jobs(spark, graph_files, tmp_path):
    adjacency, people = graph_files
    out = str(tmp_path / "out")
    jobs.mutual_friend(spark, adjacency, out, 1, 5)
    assert read(spark, out) == ["1,5\t2,3"]
    jobs.mutual_friend(spark, adjacency, out, 4, 6)
    assert read(spark, out) == ["4,6\t"]
    jobs.common_friend(spark, adjacency, out, [1, 2, 5])
    assert read(spark, out) == ["2\t2", "3\t3"]
    jobs.mutual_friend_zip(spark, adjacency, people, out, 1, 5)
    assert read(spark, out) == ["1,5\tN2 L2:02000,N3 L3:03000"]
    jobs.mutual_friend_zip(spark, adjacency, people, out, 4, 6)
    assert read(spark, out) == []
    jobs.recommend_friend(spark, adjacency, out, [1, 4, 6])
    assert read(spark, out) == ["1\t5", "4\t2,3"]
    jobs.recommend_friend(spark, adjacency, out, [4], k=None)
    assert read(spark, out) == ["4\t2,3"]


def test_age_job_writes_one_ordered_report(spark, graph_files, tmp_path):
    adjacency, people = graph_files
    out = str(tmp_path / "out")
    jobs.top_average_age(spark, adjacency, people, out, unit="year", rank_on="rounded")
    rows = [r.value for r in spark.read.text(out).collect()]
    assert rows == [
        "4\t4 Main, Town, TX, 65.00",
        "5\t5 Main, Town, TX, 63.50",
        "3\t3 Main, Town, TX, 63.33",
        "1\t1 Main, Town, TX, 63.00",
        "2\t2 Main, Town, TX, 63.00",
    ]


def test_movie_jobs(spark, files):
    movies = files("movies", "1:One:Action|War", "2:Two:War", "3:Three:War|Action|X", "bad:row")
    rated = files("rated", "10:1:1:0", "11:3:1:0", "10:3:1:0", "12:2:1:0", "x:2:1:0")
    users = files("users", "10:F:25:1:10001", "11:F:35:1:10001", "12:F:25:1:10001")
    assert [r.user_id for r in jobs.lowest_rated(spark, movies, rated, users).collect()] == [10, 10]
    assert [r.user_id for r in jobs.lowest_rated(spark, movies, rated, users, distinct=True).collect()] == [10]
    groups = {r.item_id: (len(r.ratings), r.movies[0].title) for r in jobs.movies_with_ratings(spark, movies, rated).collect()}
    assert groups == {1: (1, "One"), 2: (1, "Two"), 3: (2, "Three")}
    texts = {r.title: r.genres_text for r in jobs.numbered_genres(spark, movies, "me").collect()}
    assert texts["Three"] == "1) War, 2) Action & 3) X <me>".replace("<me>", "me")


def test_model_jobs(spark, files):
    rated = files("rated", *(f"{u}::{i}::{1 + (u + i) % 5}::0" for u in range(1, 12) for i in range(1, 9) if (u + i) % 3))
    movies = files("movies", *(f"{i}::m{i}::G" for i in range(1, 9)))
    samples = jobs.cluster_movies(spark, movies, rated).collect()
    assert sorted(r.item_id for r in samples) == list(range(1, 9))
    scores = jobs.predict_ratings(spark, rated, [1, 2], [3, 4], rounds=2).collect()
    assert {(r.user_id, r.item_id) for r in scores} == {(1, 3), (2, 4)}
    glass = files("glass", *(f"{n},{n % 2 * 5 + 1},{7 - n % 2 * 5},{n % 2 + 1}" for n in range(60)))
    for method in ("decision_tree", "naive_bayes"):
        assert jobs.classify_file(spark, glass, method).first().accuracy == 1.0


def test_profiles_without_a_birth_date_keep_their_names(spark, files, tmp_path, caplog):
    adjacency = files("adj2", "1\t3,4,5", "2\t3,4,5", "x\t9")
    people = files("people2", *(f"{u},N{u},L{u},{u} Main,Town,TX,0{u}000,,,{dob}" for u, dob in ((3, "1/2/1990"), (4, "unknown"), (5, ""))))
    out = str(tmp_path / "names")
    with caplog.at_level("WARNING", logger="kithwork.jobs"):
        jobs.mutual_friend_zip(spark, adjacency, people, out, 1, 2)
    assert read(spark, out) == ["1,2\tN3 L3:03000,N4 L4:04000,N5 L5:05000"]
    assert [r.args[0] for r in caplog.records] == [1, 2]


def test_long_lists_are_written_in_marked_runs(spark, files, tmp_path, skewed):
    friends = ",".join(map(str, range(100, 140)))
    out = str(tmp_path / "runs")
    jobs.mutual_friend(spark, files("adj3", f"1\t{friends}", f"2\t{friends}"), out, 1, 2)
    runs = [range(100, 115), range(115, 130), range(130, 140)]
    assert read(spark, out) == sorted(f"1,2{mark}\t{','.join(map(str, run))}" for mark, run in zip(("", "#1", "#2"), runs))


def test_every_job_reports_what_it_could_not_read(spark, files, caplog):
    movies = files("movies4", "1:One:Action|War", "2:Two:War", "bad:row")
    rated = files("rated4", "10:1:1:0", "11:2:1:0", "x:2:1:0", "12:2:y:0")
    users = files("users4", "10:F:25:1:10001", "z:F:35:1:10001")
    glass = files("glass4", *(f"{n},{n % 2 * 5 + 1},{7 - n % 2 * 5},{n % 2 + 1}" for n in range(60)), "x,1,2,3", "")
    with caplog.at_level("WARNING", logger="kithwork.jobs"):
        jobs.numbered_genres(spark, movies, "me")
        assert [r.args for r in caplog.records] == [(1, movies)]
        caplog.clear()
        jobs.lowest_rated(spark, movies, rated, users)
        assert [r.args for r in caplog.records] == [(1, movies), (2, rated), (1, users)]
        caplog.clear()
        assert jobs.tree_text(spark, glass).count() > 1
        assert [r.args for r in caplog.records] == [(2, glass)]
        caplog.clear()
        assert jobs.tree_text(spark, files("none4")).count() == 1
        assert not caplog.records


def test_an_input_is_scanned_once(spark, files, tmp_path, monkeypatch):
    """Steps that measure, count and join read the stored rows, not the file."""
    plans, cut = [], jobs.cut_lineage
    monkeypatch.setattr(jobs, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    adjacency = files("adj5", "1\t2,3,4", "2\t1,3,5", "x\t1")
    people = files("people5", *(f"{u},N,L,{u} Main,Town,TX,0{u}000,,,{u}/1/{1950 + u}" for u in (1, 2, 3, 4, 5)))
    out = str(tmp_path / "once")
    jobs.top_average_age(spark, adjacency, people, out)
    assert [p.count("FileScan text") for p in plans] == [1, 1] and all("CollectMetrics" in p for p in plans)
