"""Every registered query: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from kithwork import sources
from kithwork.operators import bayes, classify, clustering, demographics, factorize, graph, ratings, tree, words
from kithwork.operators.tables import keep_first as first_rows
from kithwork.session import cut_lineage, id_frame, settings, shared_folder

from .views import glass, stored, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TAG = "<kw>"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _digits(name: str, digits: int = 6) -> Column:
    return F.round(name, digits).alias(name)


def _text(items: Column) -> Column:
    return F.array_join(items.cast("array<string>"), ",")


# ---- lines, parsers and text output


@query
def word_count(spark, sf):
    return words.word_count(view(spark, sf, "lines"))


@query
def word_count_lines(spark, sf):
    return sources.as_lines(words.word_count(view(spark, sf, "lines")))


@query
def word_count_tuples(spark, sf):
    return sources.as_lines(words.word_count(view(spark, sf, "lines")), style="tuple")


@query
def adjacency_edges(spark, sf):
    lines = graph.adjacency_lines(graph.edges_adjacency(stored(spark, sf, "edges")))
    return sources.adjacency_edges(lines)


@query
def simple_edges(spark, sf):
    return graph.simple_edges(view(spark, sf, "listed"))


@query
def edges_adjacency(spark, sf):
    lists = graph.edges_adjacency(stored(spark, sf, "edges"))
    return lists.select("uid", "part", F.size("friends").alias("n"), _text(F.col("friends")).alias("friends"))


def _lines(df: DataFrame, sep: str, *fields: Column) -> DataFrame:
    return df.select(F.concat_ws(sep, *fields).alias("value"))


@query
def parse_profiles(spark, sf):
    names = ["uid", "first_name", "last_name", "street", "city", "state", "zip"]
    fields = [F.col(n).cast("string") for n in names]
    lines = _lines(view(spark, sf, "people"), ",", *fields, F.lit(""), F.lit(""), F.col("dob"))
    return sources.parse_profiles(lines)


def _table_lines(df: DataFrame, sep: str) -> DataFrame:
    return sources.as_lines(df, sep)


@query
def parse_movies(spark, sf):
    return sources.parse_movies(_table_lines(view(spark, sf, "movies"), "::"))


@query
def parse_ratings(spark, sf):
    rows = stored(spark, sf, "ratings").withColumn("rated_at", F.lit("0"))
    return sources.parse_ratings(_table_lines(rows, "::"))


@query
def parse_users(spark, sf):
    return sources.parse_users(_table_lines(view(spark, sf, "users"), ":"), sep=":")


@query
def parse_labeled(spark, sf):
    rows = glass(spark, sf)
    lines = _lines(rows, ",", F.col("id").cast("string"), _text(F.col("features")), F.col("label").cast("string"))
    parsed = sources.parse_labeled(lines)
    return parsed.select("id", "label", F.posexplode("features").alias("j", "x"))


def _planted(spark, sf, name: str, *fields: str) -> tuple[Column, list[Column], Column, DataFrame]:
    """Fields of a view in which every eleventh id and the last field of every seventh cannot be read."""
    rows = view(spark, sf, name)
    key, last = F.col(fields[0]), F.col(fields[-1])
    first = F.when(key % 11 == 0, F.concat(F.lit("x"), key.cast("string"))).otherwise(key.cast("string"))
    end = F.when(key % 7 == 0, F.lit("unknown")).otherwise(last.cast("string"))
    return first, [F.col(f).cast("string") for f in fields[1:-1]], end, rows


@query
def rejected_profiles(spark, sf):
    names = ["uid", "first_name", "last_name", "street", "city", "state", "zip", "dob"]
    first, inner, end, rows = _planted(spark, sf, "people", *names)
    return sources.rejected_lines(_lines(rows, ",", first, *inner, F.lit(""), F.lit(""), end), "profiles")


@query
def rejected_ratings(spark, sf):
    first, inner, end, rows = _planted(spark, sf, "ratings", "user_id", "item_id", "rating")
    return sources.rejected_lines(_lines(rows, "::", first, *inner, end), "ratings")


@query
def rejected_adjacency(spark, sf):
    first, _, end, rows = _planted(spark, sf, "edges", "uid", "friend")
    return sources.rejected_lines(_lines(rows, "\t", first, end), "adjacency")


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@query
def text_round_trip(spark, sf):
    """Counted words written over older output as text and read back from two paths."""
    path = _folder(spark, "words")
    counts = words.word_count(view(spark, sf, "lines"))
    sources.write_text(counts.limit(3), f"{path}/a")
    sources.write_text(counts.where(F.col("n") > 1), f"{path}/a")
    sources.write_text(counts.where(F.col("n") == 1), f"{path}/b", "errorifexists")
    return sources.read_lines(spark, f"{path}/a", f"{path}/b")


@query
def tuple_round_trip(spark, sf):
    path = _folder(spark, "tuples")
    sources.write_text(words.word_count(view(spark, sf, "lines")), path, "errorifexists", style="tuple")
    return sources.read_lines(spark, path)


@query
def refused_overwrite(spark, sf):
    """Counted words as text; writing once more to the same folder is refused and leaves it alone."""
    path = _folder(spark, "kept")
    sources.write_text(words.word_count(view(spark, sf, "lines")), path, "errorifexists")
    try:
        sources.write_text(view(spark, sf, "lines").select("value"), path, "errorifexists")
    except AnalysisException as refused:
        if refused.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        return sources.read_lines(spark, path)
    raise RuntimeError("an existing folder was written to")


def _counted(spark, lines: DataFrame, path: str, parse: Callable) -> DataFrame:
    """How many rows were read and how many lines lost a value, both from one scan of a file."""
    lines.write.text(path)
    rejects = Observation()
    rows = cut_lineage(parse(sources.read_lines(spark, path), rejects))
    return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("rejected", F.lit(rejects.get[sources.REJECTED]))


@query
def counted_profiles(spark, sf):
    names = ["uid", "first_name", "last_name", "street", "city", "state", "zip", "dob"]
    first, inner, end, rows = _planted(spark, sf, "people", *names)
    lines = _lines(rows, ",", first, *inner, F.lit(""), F.lit(""), end)
    return _counted(spark, lines, _folder(spark, "people"), lambda x, r: sources.parse_profiles(x, r))


@query
def counted_ratings(spark, sf):
    first, inner, end, rows = _planted(spark, sf, "ratings", "user_id", "item_id", "rating")
    return _counted(spark, _lines(rows, "::", first, *inner, end), _folder(spark, "rated"), lambda x, r: sources.parse_ratings(x, rejects=r))


@query
def counted_adjacency(spark, sf):
    first, _, end, rows = _planted(spark, sf, "edges", "uid", "friend")
    return _counted(spark, _lines(rows, "\t", first, end), _folder(spark, "lists"), lambda x, r: sources.adjacency_edges(x, r))


def _delimited(spark, sf, name: str, schema: str, sep: str) -> DataFrame:
    path = _folder(spark, name)
    sources.as_lines(view(spark, sf, name), sep).write.text(path)
    return sources.read_delimited(spark, path, schema, sep)


@query
def delimited_movies(spark, sf):
    return _delimited(spark, sf, "movies", sources.MOVIES, "::")


@query
def delimited_users(spark, sf):
    return _delimited(spark, sf, "users", sources.USERS, ":")


@query
def saved_naive_bayes(spark, sf):
    """Predictions of a model and its classes after saving and loading both."""
    train, test = classify.split_by_id(glass(spark, sf))
    classes = classify.class_values(train)
    path = _folder(spark, "bayes")
    classify.save_model(classify.fit_naive_bayes(train, classes), path, classes)
    model, known = classify.load_naive_bayes(path)
    return classify.predict(model, test, known)


# ---- friend graph


def _friend_pairs(spark, sf) -> DataFrame:
    """Every pair of users that are friends of each other."""
    edges = stored(spark, sf, "edges")
    return edges.where(F.col("uid") < F.col("friend")).select(F.col("uid").alias("u1"), F.col("friend").alias("u2"))


@query
def mutual_friends(spark, sf):
    return graph.mutual_friends(stored(spark, sf, "edges"), _friend_pairs(spark, sf))


def _hub_graph(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The graph with two users more, who are friends of all others but every third and every fifth, and their pair."""
    edges = stored(spark, sf, "edges")
    users = edges.select(F.col("uid").alias("friend")).distinct()
    hubs = [users.where(F.col("friend") % skipped != 0).select(F.lit(hub).cast("bigint").alias("uid"), "friend") for hub, skipped in ((-1, 3), (-2, 5))]
    pairs = id_frame(spark, u1=[-1], u2=[-2]).unionByName(_friend_pairs(spark, sf).where("u1 % 50 = 0").select(F.lit(-2).cast("bigint").alias("u1"), F.col("u2")).distinct())
    return edges.unionByName(hubs[0]).unionByName(hubs[1]), pairs


@query
def mutual_friends_hubs(spark, sf):
    """Two hubs, whose lists are compared as bitmaps, and pairs of one of them with ordinary users."""
    edges, pairs = _hub_graph(spark, sf)
    with settings(spark, {graph.HUB_ROWS_SETTING: "500"}):
        return graph.mutual_friends(edges, pairs)


@query
def mutual_friends_list(spark, sf):
    return graph.mutual_friends_list(stored(spark, sf, "edges"), _friend_pairs(spark, sf))


@query
def common_friends(spark, sf):
    ids = ratings.select_users(view(spark, sf, "users")).select(F.col("user_id").alias("uid"))
    return graph.common_friends(stored(spark, sf, "edges"), ids)


@query
def mutual_friend_profiles(spark, sf):
    return graph.mutual_friend_profiles(
        stored(spark, sf, "edges"), view(spark, sf, "profiles"), _friend_pairs(spark, sf)
    )


@query
def mutual_friend_profiles_list(spark, sf):
    return graph.mutual_friend_profiles_list(
        stored(spark, sf, "edges"), view(spark, sf, "profiles"), _friend_pairs(spark, sf)
    )


def _targets(spark, sf) -> DataFrame:
    """The users of the age report are the ones to recommend friends to."""
    return cut_lineage(top_friend_age(spark, sf).select(F.col("uid").alias("target")))


@query
def friend_candidates(spark, sf):
    return graph.friend_candidates(stored(spark, sf, "edges"), _targets(spark, sf))


@query
def candidate_list(spark, sf):
    return graph.candidate_list(stored(spark, sf, "edges"), _targets(spark, sf))


@query
def recommend_friends(spark, sf):
    return graph.recommend_friends(stored(spark, sf, "edges"), _targets(spark, sf))


@query
def recommendation_list(spark, sf):
    return graph.recommendation_list(stored(spark, sf, "edges"), _targets(spark, sf))


# ---- ages


@query
def profile_age(spark, sf):
    return demographics.profile_age(view(spark, sf, "people")).select("uid", _digits("age"))


@query
def keep_first(spark, sf):
    """The first profile of every city."""
    people = view(spark, sf, "people").select("city", "zip", "uid", "street")
    return first_rows(people, "city", "zip", "uid")


@query
def friend_age_avg(spark, sf):
    rows = demographics.friend_age_avg(stored(spark, sf, "edges"), view(spark, sf, "profiles"))
    return rows.select("uid", _digits("avg_age"), "n")


def _top(spark, sf, **options) -> DataFrame:
    rows = demographics.top_friend_age(stored(spark, sf, "edges"), view(spark, sf, "profiles"), **options)
    return rows.select("rank", "uid", "address", _digits("avg_age"))


@query
def top_friend_age(spark, sf):
    return _top(spark, sf)


@query
def top_friend_age_year(spark, sf):
    return _top(spark, sf, unit="year")


@query
def age_report_lines(spark, sf):
    """The report as text, with averages to two decimals."""
    top = demographics.top_friend_age(stored(spark, sf, "edges"), view(spark, sf, "profiles"))
    return demographics.report_lines(top)


@query
def top_friend_age_rounded(spark, sf):
    return _top(spark, sf, unit="year", rank_on="rounded")


# ---- movies, ratings and users


def _questioned(spark, sf) -> tuple[DataFrame, DataFrame]:
    return stored(spark, sf, "ratings"), ratings.select_movies(view(spark, sf, "movies"))


@query
def select_users(spark, sf):
    return ratings.select_users(view(spark, sf, "users"))


@query
def select_movies(spark, sf):
    return ratings.select_movies(view(spark, sf, "movies"))


@query
def movie_avg_rating(spark, sf):
    return ratings.movie_avg_rating(*_questioned(spark, sf)).select("item_id", _digits("avg_rating"))


@query
def lowest_rated_movies(spark, sf):
    return ratings.lowest_rated_movies(*_questioned(spark, sf)).select("item_id", _digits("avg_rating"))


@query
def lowest_rated_movie(spark, sf):
    return ratings.lowest_rated_movies(*_questioned(spark, sf), ties=False).select("item_id", _digits("avg_rating"))


@query
def raters_of_lowest(spark, sf):
    return ratings.raters_of_lowest(*_questioned(spark, sf), ratings.select_users(view(spark, sf, "users")))


@query
def raters_of_lowest_distinct(spark, sf):
    return ratings.raters_of_lowest(
        *_questioned(spark, sf), ratings.select_users(view(spark, sf, "users")), distinct=True
    )


def _cogroup(spark, sf, limit=None) -> DataFrame:
    rows = ratings.movie_rating_cogroup(stored(spark, sf, "ratings"), view(spark, sf, "movies"), limit)
    rated = F.transform("ratings", lambda r: F.concat_ws(":", r["user_id"].cast("string"), r["rating"].cast("string")))
    known = F.transform("movies", lambda m: F.concat_ws(":", m["title"], m["genres"]))
    return rows.select("item_id", "part", F.array_join(rated, ",").alias("ratings"), F.array_join(known, ",").alias("movies"))


@query
def movie_rating_cogroup(spark, sf):
    return _cogroup(spark, sf)


@query
def movie_rating_cogroup_first(spark, sf):
    return _cogroup(spark, sf, limit=5)


@query
def format_genres(spark, sf):
    return ratings.format_genres(view(spark, sf, "movies"), TAG)


@query
def format_genres_exact(spark, sf):
    return ratings.format_genres(view(spark, sf, "movies"), TAG, exact=True)


@query
def rating_stats(spark, sf):
    return ratings.rating_stats(stored(spark, sf, "ratings"))


@query
def rating_stats_merged(spark, sf):
    """Distinct counts from sketches of every rating value, merged: within 4 % of the exact ones, and the rows."""
    rated = stored(spark, sf, "ratings")
    found = ratings.merged_stats(cut_lineage(ratings.rating_sketches(rated, "rating")))
    exact = ratings.rating_stats(rated).select(F.col("users").alias("u"), F.col("items").alias("i"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.col(b) * 0.04
    return found.join(F.broadcast(exact)).select(near("users", "u").alias("users"), near("items", "i").alias("items"), "n")


# ---- clustering


@query
def item_vectors(spark, sf):
    vectors = clustering.item_vectors(stored(spark, sf, "ratings"), first_user=0)
    entries = F.transform(
        F.arrays_zip("indices", "values"),
        lambda e: F.concat_ws(":", e["indices"].cast("string"), e["values"].cast("int").cast("string")),
    )
    return vectors.select("item_id", "part", F.col("size").cast("int").alias("size"), F.array_join(entries, ",").alias("entries"))


# Ids up to WIDE_UP_TO have a multiple of WIDE_STEP in 64 bits, those beyond go on in the steps that are left.
WIDE_STEP = 300_000_000_000_000
WIDE_UP_TO = (2**63 - 1) // WIDE_STEP
NARROW_STEP = 1000


def _wide_ids(spark, sf) -> DataFrame:
    """The ratings with user ids far apart, up to 2^63, in the order of the ids."""
    rows = stored(spark, sf, "ratings")
    user = F.col("user_id")
    near = F.greatest(F.least(user, F.lit(WIDE_UP_TO)), F.lit(-WIDE_UP_TO))
    return rows.withColumn("user_id", F.when(user.isNotNull(), near * WIDE_STEP + (user - near) * NARROW_STEP))


@query
def dense_item_vectors(spark, sf):
    vectors = clustering.dense_item_vectors(_wide_ids(spark, sf))
    entries = F.transform(
        F.arrays_zip("indices", "values"),
        lambda e: F.concat_ws(":", e["indices"].cast("string"), e["values"].cast("int").cast("string")),
    )
    return vectors.select("item_id", "part", "size", F.array_join(entries, ",").alias("entries"))


@query
def user_positions(spark, sf):
    return clustering.user_positions(_wide_ids(spark, sf))


@query
def kmeans_mllib_dense(spark, sf):
    """The library model over dense vectors: its 32-bit positions do not limit the ids."""
    found = clustering.kmeans_mllib(clustering.dense_item_vectors(_wide_ids(spark, sf)))
    return found.select("item_id", F.col("cluster").between(0, clustering.CLUSTERS - 1).alias("in_range"))


def _clusters(spark, sf) -> DataFrame:
    return clustering.kmeans_items(stored(spark, sf, "ratings"))


@query
def kmeans_items(spark, sf):
    return _clusters(spark, sf).select("item_id", "cluster", _digits("sq_dist"))


@query
def kmeans_cost(spark, sf):
    return clustering.kmeans_cost(_clusters(spark, sf)).select(_digits("cost", 4))


@query
def cluster_samples(spark, sf):
    return clustering.cluster_samples(_clusters(spark, sf), view(spark, sf, "movies"))


@query
def cluster_sample_lines(spark, sf):
    """The samples as comma-joined text of movie id, title and genres."""
    return clustering.sample_lines(cluster_samples(spark, sf))


@query
def kmeans_mllib(spark, sf):
    """The library model's clusters differ with its random start; every item has one of them."""
    found = clustering.kmeans_mllib(clustering.item_vectors(stored(spark, sf, "ratings"), first_user=0))
    return found.select("item_id", F.col("cluster").between(0, clustering.CLUSTERS - 1).alias("in_range"))


# ---- classification


@query
def split_by_id(spark, sf):
    train, test = classify.split_by_id(glass(spark, sf).select("id", "label"))
    return train.withColumn("side", F.lit("train")).union(test.withColumn("side", F.lit("test")))


@query
def naive_bayes(spark, sf):
    return classify.naive_bayes(glass(spark, sf))


@query
def naive_bayes_accuracy(spark, sf):
    return classify.accuracy(classify.naive_bayes(glass(spark, sf))).select(_digits("accuracy"), "n")


@query
def naive_bayes_mllib(spark, sf):
    return classify.naive_bayes_mllib(glass(spark, sf))


@query
def naive_bayes_tables(spark, sf):
    """Predictions of a model of two tables after saving and loading them."""
    train, test = classify.split_by_id(glass(spark, sf))
    path = _folder(spark, "bayes_tables")
    bayes.save_bayes(bayes.fit_bayes(train), path)
    return bayes.predict_bayes(bayes.load_bayes(spark, path), test)


@query
def decision_tree(spark, sf):
    return classify.decision_tree(glass(spark, sf))


@query
def decision_tree_accuracy(spark, sf):
    return classify.accuracy(classify.decision_tree(glass(spark, sf))).select(_digits("accuracy"), "n")


@query
def decision_tree_text(spark, sf):
    train, _ = classify.split_by_id(glass(spark, sf))
    return tree.tree_text(tree.fit_tree(train))


@query
def decision_tree_nodes(spark, sf):
    """The table of nodes after saving and loading it."""
    train, _ = classify.split_by_id(glass(spark, sf))
    path = _folder(spark, "tree")
    tree.save_tree(tree.fit_tree(train), path)
    return tree.load_tree(spark, path).nodes


@query
def decision_tree_mllib(spark, sf):
    """The library model cuts features at values of a random sample; every row gets one of the known labels."""
    rows = glass(spark, sf)
    labels = rows.select(F.col("label").alias("prediction")).distinct().withColumn("known", F.lit(True))
    found = classify.decision_tree_mllib(rows).join(labels, "prediction", "left")
    return found.select("id", "label", F.coalesce("known", F.lit(False)).alias("known"))


# ---- factorisation


def _wide(factors: DataFrame, key: str, digits: int) -> DataFrame:
    return factors.select(key, *(F.round(F.get("factors", F.lit(i)), digits).alias(f"f{i}") for i in range(factorize.RANK)))


@query
def als_user_factors(spark, sf):
    return _wide(factorize.als_factors(stored(spark, sf, "ratings"))[0], "user_id", 4)


@query
def als_item_factors(spark, sf):
    return _wide(factorize.als_factors(stored(spark, sf, "ratings"))[1], "item_id", 4)


@query
def als_user_factors_constant(spark, sf):
    users, _ = factorize.als_factors(stored(spark, sf, "ratings"), rounds=1, init="constant")
    return _wide(users, "user_id", 6)


@query
def als_factor_lookup(spark, sf):
    """The factors of the users who rated a lowest-rated movie."""
    users, _ = factorize.als_factors(stored(spark, sf, "ratings"), rounds=1, init="constant")
    asked = raters_of_lowest_distinct(spark, sf)
    return _wide(factorize.factor_lookup(users, asked), "user_id", 6)


def _stored_factors(spark, sf) -> tuple[DataFrame, DataFrame]:
    found = factorize.als_factors(stored(spark, sf, "ratings"), rounds=1, init="constant")
    stores = [factorize.save_factors(f, _folder(spark, "factors")) for f in found]
    return tuple(factorize.load_factors(spark, s.path) for s in stores)


@query
def als_stored_lookup(spark, sf):
    """``als_factor_lookup`` from factors stored in buckets."""
    users, _ = _stored_factors(spark, sf)
    return _wide(factorize.factor_lookup(users, raters_of_lowest_distinct(spark, sf)), "user_id", 6)


@query
def als_stored_predict(spark, sf):
    rated = stored(spark, sf, "ratings")
    return factorize.als_predict(rated, *_stored_factors(spark, sf)).select("user_id", "item_id", _digits("score", 6))


@query
def als_predict(spark, sf):
    rated = stored(spark, sf, "ratings")
    users, items = factorize.als_factors(rated)
    return factorize.als_predict(rated, users, items).select("user_id", "item_id", _digits("score", 4))


@query
def als_loss(spark, sf):
    rated = stored(spark, sf, "ratings")
    return factorize.als_loss(rated, *factorize.als_factors(rated)).select(_digits("loss", 3))


@query
def als_mllib(spark, sf):
    return factorize.als_mllib(stored(spark, sf, "ratings"))[0].select("user_id", F.size("factors").alias("k"))
