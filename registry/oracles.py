"""DuckDB SQL for the registered queries, written apart from the Spark code."""

from __future__ import annotations

from kithwork.functions.columns import HASH_MODULUS, HASH_MULTIPLIER
from kithwork.operators.classify import TRAIN_SHARE
from kithwork.operators.tree import LEAST_GAIN, MAX_BINS, MAX_DEPTH
from kithwork.operators.clustering import CLUSTERS, DIGITS, ITERATIONS
from kithwork.operators.factorize import RANK, ROUNDS

from .views import DUCKDB


def _with(names: list[str], ctes: dict[str, str], body: str) -> str:
    parts = [f"{name} as materialized ({DUCKDB[name].strip()})" for name in names]
    parts += [f"{name} as materialized ({text.strip()})" for name, text in ctes.items()]
    return "with " + ",\n".join(parts) + "\n" + body.strip()


def _view(name: str, body: str) -> str:
    return _with([name], {}, body)


def _hash(key: str, seed: int, stream: int = 0) -> str:
    multiplier = pow(HASH_MULTIPLIER, stream + 1, HASH_MODULUS)
    return f"((({key}) % {HASH_MODULUS}) * {multiplier} + {seed}) % {HASH_MODULUS}"


WORDS = {
    "words": """
select unnest(case when value='' then [''] when rtrim(value,' ')='' then []
              else string_split(rtrim(value,' '),' ') end) as word from lines""",
    "counts": "select word, count(*) n from words group by word",
}

PAIRS = {
    "pairs": "select uid u1, friend u2 from edges where uid < friend",
    "mutual": """
select p.u1, p.u2, a.friend from pairs p join edges a on a.uid = p.u1
join edges b on b.uid = p.u2 and b.friend = a.friend""",
}

NAMED = {
    **PAIRS,
    "named": """
select u1, u2, friend, first_name || ' ' || last_name as name, zip from mutual join profiles on uid = friend""",
}


def _averages(unit: str) -> str:
    birth = "cast(split_part(dob,'/',3) as bigint)"
    month = "cast(split_part(dob,'/',1) as bigint)"
    age = {"month": f"(2016 - {birth}) * 12 + 2 - {month}", "year": f"2016 - {birth}"}[unit]
    years = {"month": 12, "year": 1}[unit]
    return f"""
select e.uid, sum({age}) / (count(*) * {years}.0e0) avg_age, count(*) n
from edges e join profiles p on p.uid = e.friend group by e.uid"""


def _top(unit: str, rounded: bool = False) -> dict[str, str]:
    average = "round(avg_age, 2)" if rounded else "avg_age"
    return {
        "averages": _averages(unit),
        "report": f"""
select row_number() over (order by {average} desc, uid) rank, uid,
  street || ', ' || city || ', ' || state address, {average} avg_age
from averages join profiles using (uid) order by {average} desc, uid limit 20""",
    }


TOP_BODY = "select cast(rank as int) rank, uid, address, round(avg_age, 6) avg_age from report"

CANDIDATES = {
    **_top("month"),
    "targets": "select uid target from report",
    "candidates": """
select target, e2.friend candidate, count(*) n
from targets join edges e1 on e1.friend = target join edges e2 on e2.uid = e1.uid and e2.friend <> target
where not exists (select 1 from edges d where d.uid = target and d.friend = e2.friend)
group by 1, 2""",
    "ranked": """
select *, row_number() over (partition by target order by n desc, candidate) rank from candidates""",
}

ASKED_USERS = "gender = 'F' and age > 20 and age < 35 and regexp_full_match(zip, '1.*')"
ASKED_MOVIES = "contains(genres, 'Action') and contains(genres, 'War')"

AVERAGES = {
    "averages": f"""
select item_id, avg(rating) avg_rating from ratings join (select item_id from movies where {ASKED_MOVIES})
using (item_id) group by item_id""",
    "lowest": "select * from averages where avg_rating = (select min(avg_rating) from averages)",
}

RATERS = {
    **AVERAGES,
    "raters": f"""
select r.user_id from ratings r join lowest using (item_id) join users u on u.user_id = r.user_id
where {ASKED_USERS}""",
}

COGROUP = {
    "r": "select item_id, string_agg(user_id || ':' || rating, ',' order by user_id, rating) ratings from ratings group by 1",
    "m": "select item_id, string_agg(title || ':' || genres, ',' order by title, genres) movies from movies group by 1",
    "grouped": "select item_id, 0 part, ratings, movies from r join m using (item_id)",
}


def _genres(single: str) -> str:
    return f"""
select title, case when len(g) = 1 then '{single}1) ' || g[1]
  else list_aggregate([i || ') ' || g[i] for i in range(1, len(g))], 'string_agg', ', ')
       || ' & ' || len(g) || ') ' || g[len(g)] end || ' <kw>' genres_text
from (select title, string_split(genres, '|') g from movies)"""


def _kmeans(body: str, names: list[str]) -> str:
    """The iterations written out: centres, distances and nearest clusters by turns."""
    ctes = {
        "pts": "select item_id, user_id, avg(rating) x from ratings group by 1, 2",
        "sq": "select item_id, sum(x*x) s from pts group by 1",
        "a0": f"""
select item_id, row_number() over (order by h, item_id) - 1 cluster
from (select item_id, {_hash('item_id', 11)} h from sq order by h, item_id limit {CLUSTERS})""",
    }
    for t in range(1, ITERATIONS + 1):
        kept = "" if t == 1 else f" union all select * from c{t-1} where cluster not in (select cluster from a{t-1})"
        ctes[f"c{t}"] = f"""
select user_id, cluster, sum(x) / any_value(n) v from pts join a{t-1} using (item_id)
join (select cluster, count(*) n from a{t-1} group by 1) using (cluster) group by 1, 2{kept}"""
        ctes[f"p{t}"] = f"select item_id, cluster, sum(x*v) p from pts join c{t} using (user_id) group by 1, 2"
        ctes[f"d{t}"] = f"""
select item_id, cluster, round(s - 2*coalesce(p, 0) + norm, {DIGITS}) d
from sq cross join (select cluster, sum(v*v) norm from c{t} group by 1) left join p{t} using (item_id, cluster)"""
        ctes[f"a{t}"] = f"""
select item_id, cluster, d from (select *, row_number() over (partition by item_id order by d, cluster) k from d{t})
where k = 1"""
    return _with(names, ctes, body.format(last=f"a{ITERATIONS}"))


def _als(rounds: int, body: str) -> str:
    """The rounds written out: sums per id, then elimination column by column."""
    names = ", ".join(f"f{i}" for i in range(RANK))
    start = ", ".join(f"({_hash('user_id', 7, i)}) / {float(HASH_MODULUS)!r}e0 f{i}" for i in range(RANK))
    ctes = {"u0": f"select user_id, {start} from (select distinct user_id from ratings)"}

    def half(name: str, source: str, by: str, key: str) -> None:
        sums = [f"sum(f{i}*f{j}) + {1 if i == j else 0} a{i}{j}" for i in range(RANK) for j in range(i, RANK)]
        sums += [f"sum(rating*f{i}) b{i}" for i in range(RANK)]
        steps = f"select {key}, {', '.join(sums)} from ratings join {source} using ({by}) group by 1"
        for p in range(RANK - 1):
            columns = [f"a{i}{j}" for i in range(p + 1) for j in range(i, RANK)] + [f"b{i}" for i in range(p + 1)]
            for i in range(p + 1, RANK):
                columns += [f"a{i}{j} - (a{p}{i}/a{p}{p})*a{p}{j} a{i}{j}" for j in range(i, RANK)]
                columns.append(f"b{i} - (a{p}{i}/a{p}{p})*b{p} b{i}")
            steps = f"select {key}, {', '.join(columns)} from ({steps})"
        for p in reversed(range(RANK)):
            known = "".join(f" - a{p}{j}*f{j}" for j in range(p + 1, RANK))
            steps = f"select *, (b{p}{known})/a{p}{p} f{p} from ({steps})"
        ctes[name] = f"select {key}, {names} from ({steps})"

    for t in range(1, rounds + 1):
        half(f"i{t}", f"u{t-1}", "user_id", "item_id")
        half(f"u{t}", f"i{t}", "item_id", "user_id")
    return _with(["ratings"], ctes, body.format(users=f"u{rounds}", items=f"i{rounds}"))


def _factors(key: str, table: str) -> str:
    return f"select {key}, " + ", ".join(f"round(f{i}, 4) f{i}" for i in range(RANK)) + f" from {table}"


def _score(u: str = "u", i: str = "i") -> str:
    return " + ".join(f"{u}.f{j}*{i}.f{j}" for j in range(RANK))


SPLIT = f"{_hash('id', 11)} < {int(TRAIN_SHARE * HASH_MODULUS)}"

BAYES = {
    "train": f"select * from glass_long where {SPLIT}",
    "test": f"select * from glass_long where not ({SPLIT})",
    "sizes": "select label, count(distinct id) n from train group by 1",
    "prior": "select label, ln(n + 1) - ln((select sum(n) from sizes) + (select count(*) from sizes)) p from sizes",
    "cells": "select label, j, sum(x) s from train group by 1, 2",
    "terms": """
select label, j, ln(s + 1) - ln(sum(s) over (partition by label) + count(*) over (partition by label)) w from cells""",
    "scores": """
select t.id, t.label, c.label guess, any_value(p) + sum(t.x * w) score
from test t join terms c on c.j = t.j join prior on prior.label = c.label group by 1, 2, 3""",
    "bayes": """
select id, cast(label as double) label, cast(guess as double) prediction
from (select *, row_number() over (partition by id order by score desc, guess) k from scores) where k = 1""",
}

def _tree(body: str) -> str:
    """Cuts from ranks of sorted values, then every level rated from scratch on its rows, by Gini impurity."""
    ctes = {
        "train": f"select * from glass_long where {SPLIT}",
        "test": f"select * from glass_long where not ({SPLIT})",
        "ranked": """
select j, x, max(r) r, min(r) - 1 b, any_value(m) m, dense_rank() over (partition by j order by x) v
from (select j, x, row_number() over (partition by j order by x) r, count(*) over (partition by j) m from train) group by j, x""",
        "cuts": f"""
select j, x t from (select *, max(v) over (partition by j) d from ranked)
where r < m and (d <= {MAX_BINS} or r * {MAX_BINS} // m > b * {MAX_BINS} // m)""",
        "n0": "select distinct id, label, 1::bigint node from train",
        "w0": "select distinct id, 1::bigint node from test",
    }
    for d in range(MAX_DEPTH + 1):
        ctes[f"c{d}"] = f"select node, label, count(*) n from n{d} group by 1, 2"
        ctes[f"g{d}"] = f"select node, sum(n) n, sum(n*n) / sum(n)::double purity, arg_max(label, (n, -label)) label from c{d} group by 1"
        if d == MAX_DEPTH:
            break
        ctes[f"s{d}"] = f"""
select node, j, t, sum(l) nl, sum(l*l) / sum(l)::double + sum((n-l)*(n-l)) / sum(n-l)::double rating from (
  select c.node, u.j, u.t, c.label, any_value(c.n) n, count(x.id) l from c{d} c cross join cuts u
  left join (select r.node, r.label, r.id, a.j, a.x from n{d} r join train a using (id)) x
    on x.node = c.node and x.label = c.label and x.j = u.j and x.x <= u.t group by 1, 2, 3, 4)
group by 1, 2, 3 having sum(l) > 0 and sum(n-l) > 0"""
        ctes[f"b{d}"] = f"""
select node, j, t from (select *, row_number() over (partition by node order by rating desc, j, t) k
  from s{d} join g{d} using (node) where rating - purity > {LEAST_GAIN!r}) where k = 1"""
        for rows, kind, source in (("n", ", r.label", "train"), ("w", "", "test")):
            ctes[f"{rows}{d+1}"] = f"""
select r.id{kind}, r.node * 2 + (a.x > b.t)::int node
from {rows}{d} r join b{d} b using (node) join {source} a on a.id = r.id and a.j = b.j"""
    levels = range(MAX_DEPTH + 1)
    ctes["nodes"] = " union all ".join(
        f"select g.node, {d} depth, g.n, g.label, " + ("b.j, b.t" if d < MAX_DEPTH else "null j, null t") + f" from g{d} g" + (f" left join b{d} b using (node)" if d < MAX_DEPTH else "")
        for d in levels)
    ctes["walked"] = " union all ".join(f"select id, node from w{d}" for d in levels)
    ctes["predicted"] = """
select w.id, cast(e.label as double) label, cast(n.label as double) prediction
from walked w join nodes n using (node) join (select distinct id, label from test) e on e.id = w.id where n.j is null"""
    ctes["paths"] = "select *, substr(ltrim(bin(node), '0'), 2) path, repeat(' ', depth + 2) pad from nodes"
    ctes["written"] = """
select '' path, -1 kind, 'DecisionTreeModel classifier of depth ' || max(depth) || ' with ' || count(*) || ' nodes' line from nodes
union all select path, 2, pad || 'If (feature ' || j || ' <= ' || t || ')' from paths where j is not null
union all select path || '1', 0, pad || 'Else (feature ' || j || ' > ' || t || ')' from paths where j is not null
union all select path, 2, pad || 'Predict: ' || cast(label as double) from paths where j is null"""
    return _with(["glass_long"], ctes, body)


# One round from a constant start: all factors of an id are equal.
SCALAR = {
    "i": "select item_id, sum(rating*0.5e0)/(1+5*sum(0.25e0)) f from ratings group by 1",
    "u": "select r.user_id, sum(r.rating*i.f)/(1+5*sum(i.f*i.f)) f from ratings r join i on r.item_id=i.item_id group by 1",
}
SCALAR_BODY = "select user_id, " + ", ".join(f"round(f, 6) f{j}" for j in range(RANK)) + " from u"

ORACLES: dict[str, str] = {
    "word_count": _with(["lines"], WORDS, "select word, n from counts"),
    "word_count_lines": _with(["lines"], WORDS, "select word || chr(9) || n as value from counts"),
    "word_count_tuples": _with(["lines"], WORDS, "select '(' || word || ',' || n || ')' as value from counts"),
    "adjacency_edges": _view("edges", "select uid, friend from edges"),
    "simple_edges": _view("listed", "select distinct uid, friend from listed where uid <> friend"),
    "edges_adjacency": _view("edges", """
select uid, 0 part, cast(count(*) as int) n, string_agg(friend, ',' order by friend) friends from edges group by uid"""),
    "parse_profiles": _view("people", """
select *, cast(split_part(dob,'/',1) as int) birth_month, cast(split_part(dob,'/',3) as int) birth_year from people"""),
    "parse_movies": _view("movies", "select item_id, title, genres from movies"),
    "parse_ratings": _view("ratings", "select user_id, item_id, rating, '0' rated_at from ratings"),
    "parse_users": _view("users", "select user_id, gender, age, occupation, zip from users"),
    "parse_labeled": _view("glass_long", "select id, cast(label as double) label, cast(j as int) j, x from glass_long"),
    "mutual_friends": _with(["edges"], PAIRS, "select u1, u2, friend from mutual"),
    "mutual_friends_hubs": _with(["edges"], {
        "ids": "select distinct uid friend from edges",
        "whole": "select uid, friend from edges union all select -1, friend from ids where friend % 3 <> 0 union all select -2, friend from ids where friend % 5 <> 0",
        "asked": "select -1::bigint u1, -2::bigint u2 union all select distinct -2, friend from edges where uid < friend and uid % 50 = 0",
    }, "select p.u1, p.u2, a.friend from asked p join whole a on a.uid = p.u1 join whole b on b.uid = p.u2 and b.friend = a.friend"),
    "mutual_friends_list": _with(["edges"], PAIRS, """
select u1, u2, 0 part, coalesce(string_agg(friend, ',' order by friend), '') friends
from pairs left join mutual using (u1, u2) group by 1, 2"""),
    "common_friends": _with(["edges", "users"], {}, f"""
select friend, count(*) n from edges where uid in (select user_id from users where {ASKED_USERS})
group by friend having count(*) >= 2"""),
    "mutual_friend_profiles": _with(["edges", "profiles"], NAMED, "select * from named"),
    "mutual_friend_profiles_list": _with(["edges", "profiles"], NAMED, """
select u1, u2, 0 part, string_agg(name || ':' || zip, ',' order by friend) profiles from named group by 1, 2"""),
    "friend_candidates": _with(["edges", "profiles"], CANDIDATES, "select target, candidate, n from candidates"),
    "candidate_list": _with(["edges", "profiles"], CANDIDATES, """
select target, 0 part, coalesce(string_agg(candidate, ',' order by candidate), '') candidates
from targets left join candidates using (target) group by 1"""),
    "recommend_friends": _with(["edges", "profiles"], CANDIDATES, """
select target, cast(rank as int) rank, candidate, n from ranked where rank <= 10"""),
    "recommendation_list": _with(["edges", "profiles"], CANDIDATES, """
select target, coalesce(string_agg(candidate, ',' order by rank), '') candidates
from targets left join (select * from ranked where rank <= 10) using (target) group by 1"""),
    "profile_age": _view("people", """
select uid, round(((2016 - cast(split_part(dob,'/',3) as bigint)) * 12 + 2 - cast(split_part(dob,'/',1) as bigint)) / 12.0e0, 6) age
from people"""),
    "friend_age_avg": _with(["edges", "profiles"], {"averages": _averages("month")},
                            "select uid, round(avg_age, 6) avg_age, n from averages"),
    "top_friend_age": _with(["edges", "profiles"], _top("month"), TOP_BODY),
    "top_friend_age_year": _with(["edges", "profiles"], _top("year"), TOP_BODY),
    "top_friend_age_rounded": _with(["edges", "profiles"], _top("year", rounded=True), TOP_BODY),
    "age_report_lines": _with(["edges", "profiles"], _top("month"), """
select cast(rank as int) rank, uid, address || ', ' || cast(cast(round(cast(avg_age as decimal(18, 9)), 2) as decimal(18, 2)) as varchar) as text from report"""),
    "select_users": _view("users", f"select * from users where {ASKED_USERS}"),
    "select_movies": _view("movies", f"select * from movies where {ASKED_MOVIES}"),
    "movie_avg_rating": _with(["ratings", "movies"], AVERAGES, "select item_id, round(avg_rating, 6) avg_rating from averages"),
    "lowest_rated_movies": _with(["ratings", "movies"], AVERAGES, "select item_id, round(avg_rating, 6) avg_rating from lowest"),
    "lowest_rated_movie": _with(["ratings", "movies"], AVERAGES, """
select item_id, round(avg_rating, 6) avg_rating from averages order by averages.avg_rating, item_id limit 1"""),
    "raters_of_lowest": _with(["ratings", "movies", "users"], RATERS, "select user_id from raters"),
    "raters_of_lowest_distinct": _with(["ratings", "movies", "users"], RATERS, "select distinct user_id from raters"),
    "movie_rating_cogroup": _with(["ratings", "movies"], COGROUP, "select * from grouped"),
    "movie_rating_cogroup_first": _with(["ratings", "movies"], COGROUP, "select * from grouped order by item_id limit 5"),
    "format_genres": _view("movies", _genres("")),
    "format_genres_exact": _view("movies", _genres(" ")),
    "rating_stats": _view("ratings", """
select count(distinct user_id) users, count(distinct item_id) items, count(*) n from ratings"""),
    "rating_stats_merged": _view("ratings", "select true users, true items, count(*) n from ratings"),
    "user_positions": _view("ratings", """
select distinct user_id * 300000000000000 user_id, dense_rank() over (order by user_id) - 1 as position from ratings"""),
    "dense_item_vectors": _with(["ratings"], {"p": "select *, dense_rank() over (order by user_id) - 1 i from ratings"}, """
select item_id, 0 part, (select count(distinct user_id) from ratings) size, string_agg(i || ':' || rating, ',' order by i) entries
from p group by item_id"""),
    "kmeans_mllib_dense": _view("ratings", "select distinct item_id, true in_range from ratings"),
    "item_vectors": _view("ratings", """
select item_id, 0 part, (select cast(max(user_id) + 1 as int) from ratings) size,
  string_agg(user_id || ':' || rating, ',' order by user_id) entries from ratings group by item_id"""),
    "kmeans_items": _kmeans("select item_id, cast(cluster as int) cluster, round(greatest(d, 0), 6) sq_dist from {last}", ["ratings"]),
    "kmeans_cost": _kmeans("select round(sum(greatest(d, 0)), 4) cost from {last}", ["ratings"]),
    "keep_first": _view("people", """
select city, zip, uid, street from (select *, row_number() over (partition by city order by zip, uid) k from people)
where k = 1"""),
    "cluster_sample_lines": _kmeans("""
select cast(cluster as int) cluster, item_id || ',' || title || ',' || genres as value
from (select *, row_number() over (partition by cluster order by item_id) k from {last}) join movies using (item_id)
where k <= 5""", ["ratings", "movies"]),
    "cluster_samples": _kmeans("""
select cast(cluster as int) cluster, item_id, title, genres
from (select *, row_number() over (partition by cluster order by item_id) k from {last}) join movies using (item_id)
where k <= 5""", ["ratings", "movies"]),
    "split_by_id": f"""
select vec_id id, cast(label as double) label, case when {_hash('vec_id', 11)} < {int(TRAIN_SHARE * HASH_MODULUS)}
  then 'train' else 'test' end side from embeddings""",
    "kmeans_mllib": _view("ratings", "select distinct item_id, true in_range from ratings"),
    "als_mllib": _view("ratings", f"select distinct user_id, cast({RANK} as int) k from ratings"),
    "rejected_profiles": _view("people", """
select concat_ws(',', case when uid % 11 = 0 then 'x' || uid else cast(uid as varchar) end, first_name, last_name, street, city,
  state, zip, '', '', case when uid % 7 = 0 then 'unknown' else dob end) as value
from people where uid % 11 = 0 or uid % 7 = 0"""),
    "counted_profiles": _view("people", "select count(*) filter (uid % 11 <> 0) as rows, count(*) filter (uid % 11 = 0 or uid % 7 = 0) as rejected from people"),
    "counted_ratings": _view("ratings", """
select count(*) filter (not bad) as rows, count(*) filter (bad) as rejected from (select user_id % 11 = 0 or user_id % 7 = 0 bad from ratings)"""),
    "counted_adjacency": _view("edges", """
select count(*) filter (not bad) as rows, count(*) filter (bad) as rejected from (select uid % 11 = 0 or uid % 7 = 0 bad from edges)"""),
    "rejected_ratings": _view("ratings", """
select concat_ws('::', case when user_id % 11 = 0 then 'x' || user_id else cast(user_id as varchar) end, item_id,
  case when user_id % 7 = 0 then 'unknown' else cast(rating as varchar) end) as value
from ratings where user_id % 11 = 0 or user_id % 7 = 0"""),
    "rejected_adjacency": _view("edges", """
select case when uid % 11 = 0 then 'x' || uid else cast(uid as varchar) end || chr(9)
  || case when uid % 7 = 0 then 'unknown' else cast(friend as varchar) end as value
from edges where uid % 11 = 0 or uid % 7 = 0"""),
    "delimited_movies": _view("movies", "select item_id, title, genres from movies"),
    "delimited_users": _view("users", "select user_id, gender, age, occupation, zip from users"),
    "saved_naive_bayes": _with(["glass_long"], BAYES, "select id, label, prediction from bayes"),
    "naive_bayes": _with(["glass_long"], BAYES, "select id, label, prediction from bayes"),
    "naive_bayes_accuracy": _with(["glass_long"], BAYES, """
select round(avg(cast(label = prediction as int)), 6) accuracy, count(*) n from bayes"""),
    "naive_bayes_mllib": _with(["glass_long"], BAYES, "select id, label, prediction from bayes"),
    "naive_bayes_tables": _with(["glass_long"], BAYES, "select id, label, prediction from bayes"),
    "decision_tree": _tree("select id, label, prediction from predicted"),
    "decision_tree_accuracy": _tree("select round(avg(cast(label = prediction as int)), 6) accuracy, count(*) n from predicted"),
    "decision_tree_text": _tree("select cast(row_number() over (order by path, kind) - 1 as int) n, line from written"),
    "decision_tree_nodes": _tree("""
select node, depth, cast(n as bigint) n, cast(label as double) label, cast(j as int) feature, cast(t as double) threshold from nodes"""),
    "decision_tree_mllib": f"""
select distinct id, cast(label as double) label, true known from ({DUCKDB["glass_long"]}) where not ({SPLIT})""",
    "als_user_factors": _als(ROUNDS, _factors("user_id", "{users}")),
    "als_item_factors": _als(ROUNDS, _factors("item_id", "{items}")),
    "als_user_factors_constant": _with(["ratings"], SCALAR, SCALAR_BODY),
    "als_factor_lookup": _with(["ratings", "movies", "users"], {**RATERS, **SCALAR},
                               SCALAR_BODY + " where user_id in (select user_id from raters)"),
    "als_stored_lookup": _with(["ratings", "movies", "users"], {**RATERS, **SCALAR},
                               SCALAR_BODY + " where user_id in (select user_id from raters)"),
    "als_stored_predict": _with(["ratings"], {**SCALAR, "v": "select r.item_id, sum(rating*0.5e0)/(1+5*sum(0.25e0)) f from ratings r group by 1"}, """
select r.user_id, r.item_id, round(5 * u.f * v.f, 6) score from ratings r join u using (user_id) join v using (item_id)"""),
    "als_predict": _als(ROUNDS, f"""
select r.user_id, r.item_id, round({_score()}, 4) score
from ratings r join {{users}} u on u.user_id = r.user_id join {{items}} i on i.item_id = r.item_id"""),
    "als_loss": _als(ROUNDS, f"""
select round((select sum((rating - ({_score()}))^2)
  from ratings r join {{users}} u on u.user_id = r.user_id join {{items}} i on i.item_id = r.item_id)
  + (select sum({_score('u', 'u')}) from {{users}} u) + (select sum({_score('i', 'i')}) from {{items}} i), 3) loss"""),
}
ORACLES["refused_overwrite"] = ORACLES["word_count_lines"]
ORACLES["text_round_trip"] = ORACLES["word_count_lines"]
ORACLES["tuple_round_trip"] = ORACLES["word_count_tuples"]
