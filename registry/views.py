"""Views over the given tables that have the shape of the operators' inputs.

``SPARK`` and ``DUCKDB`` hold the same views in both dialects; most texts are common, Spark groups ``ratings`` after its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kithwork.session import shared_folder
from kithwork.sources.lines import spread_splits, with_birth_date

EDGES = """
with e as (select distinct o_custkey a, (o_orderkey*7+3) % (select count(*) from customer) b from orders),
e2 as (select a, b from e where a <> b)
select a uid, b friend from e2 union select b uid, a friend from e2
"""

# Listed friends as they come: with repeats, self-loops, one direction only.
LISTED = "select o_custkey uid, (o_orderkey*7+3) % (select count(*) from customer) friend from orders"

PEOPLE = """
select c_custkey uid, split_part(c_name,'#',1) first_name, split_part(c_name,'#',2) last_name,
  concat(cast(c_custkey as string),' ',c_mktsegment) street, n_name city, r_name state,
  lpad(cast((c_custkey*37)%100000 as string),5,'0') zip,
  concat(cast((c_custkey*5)%12+1 as string),'/',cast((c_custkey*3)%28+1 as string),'/',
         cast(1940+(c_custkey*13)%60 as string)) dob
from customer join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey
"""

# Friends without a profile: every 97th customer has none.
PROFILES = f"""{PEOPLE.rstrip()}
where c_custkey%97<>0
"""

MOVIES = """
select p_partkey item_id, p_name title,
  concat_ws('|', case when p_size%2=0 then 'Action' end, case when p_size%3=0 then 'War' end,
            case when p_size%5=0 then 'Drama' end, p_type) genres
from part
"""

RATINGS = """
select o_custkey user_id, l_partkey item_id,
  max(case when l_partkey%40<2 then 1 else 1+cast(l_quantity as int)%5 end) rating
from orders join lineitem on o_orderkey=l_orderkey group by o_custkey, l_partkey
"""

# The rows that ``RATINGS`` groups, for Spark: nearly every one is a group of its own.
RATED = """
select o_custkey user_id, l_partkey item_id, case when l_partkey%40<2 then 1 else 1+cast(l_quantity as int)%5 end rating
from orders join lineitem on o_orderkey=l_orderkey
"""
# Rows that one task groups.
RATED_ROWS = 200_000

USERS = """
select c_custkey user_id, case when c_custkey%2=0 then 'F' else 'M' end gender,
  cast(10+c_custkey%50 as int) age, cast(c_custkey%21 as int) occupation,
  concat(cast(c_custkey%3 as string), lpad(cast((c_custkey*7919)%10000 as string),4,'0')) zip
from customer
"""

LINES_SPARK = "select doc_id, explode(split(text,'\\\\n')) value from documents"
LINES_DUCKDB = "select doc_id, unnest(string_split(text,chr(10))) as value from documents"

GLASS_SPARK = """
select vec_id id, label, pos j, cast(floor(abs(x)*100) as double) x
from (select vec_id, label, posexplode(embedding) as (pos, x) from embeddings)
"""
GLASS_DUCKDB = """
select vec_id id, label, j-1 j, cast(floor(abs(x)*100) as double) x
from (select vec_id, label, unnest(embedding) as x, generate_subscripts(embedding,1) as j from embeddings)
"""

COMMON = {"edges": EDGES, "listed": LISTED, "people": PEOPLE, "profiles": PROFILES, "movies": MOVIES, "ratings": RATINGS, "users": USERS}
SPARK = {**COMMON, "ratings": RATED, "lines": LINES_SPARK, "glass_long": GLASS_SPARK}
DUCKDB = {**COMMON, "lines": LINES_DUCKDB, "glass_long": GLASS_DUCKDB}

TABLES = {
    "edges": ["orders", "customer"],
    "listed": ["orders", "customer"],
    "people": ["customer", "nation", "region"],
    "profiles": ["customer", "nation", "region"],
    "movies": ["part"],
    "ratings": ["orders", "lineitem"],
    "users": ["customer"],
    "lines": ["documents"],
    "glass_long": ["embeddings"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = SPARK[name]
    tables = {t: table(spark, sf_dir, t) for t in TABLES[name]}
    if name == "lines":
        tables["documents"] = spread_splits(tables["documents"].select("doc_id", "text"), "doc_id")
    for t in tables:
        text = text.replace(f"from {t}", f"from {{{t}}}").replace(f"join {t}", f"join {{{t}}}")
    df = spark.sql(text, **tables)
    if name == "ratings":
        return _grouped(df, tables["lineitem"])
    return with_birth_date(df) if name in ("people", "profiles") else df


def _grouped(rated: DataFrame, lines: DataFrame) -> DataFrame:
    """``RATINGS`` from its rows, dealt out before they are grouped: a task that read many of them would hold them all."""
    tasks = max(1, -(-lines.count() // RATED_ROWS))
    return rated.repartition(tasks, "user_id", "item_id").groupBy("user_id", "item_id").agg(F.max("rating").alias("rating"))


def glass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, label, features): the wide form of ``glass_long``, made in place."""
    number = F.transform("embedding", lambda x: F.floor(F.abs(x) * 100).cast("double"))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("double").alias("label"), number.alias("features")
    )


_stored: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view that costs a shuffle, written once per session as a table in the shared folder.

    A friend graph or a rating table is such a table where it is real; queries then read only the
    columns they ask for, as often as they need.
    """
    application = spark.sparkContext.applicationId
    key = (application, sf_dir, name)
    if key not in _stored:
        path = f"{shared_folder(spark)}/{application}/{name}-{len(_stored)}"
        view(spark, sf_dir, name).write.mode("overwrite").parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])
