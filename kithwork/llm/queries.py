"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kithwork.llm.decontamination import decontaminate
from kithwork.llm.embedding_dedup import embedding_dedup
from kithwork.llm.html_extraction import extract_text
from kithwork.llm.language_id import language_id
from kithwork.llm.lm_scoring import lm_scores
from kithwork.llm.minhash_dedup import minhash_dedup
from kithwork.llm.packing import pack
from kithwork.llm.periodic_runs import periodic_runs, planted, run_report
from kithwork.llm.quality import quality
from kithwork.llm.repeated_bytes import removal_report, remove_repeated_bytes
from kithwork.llm.substring_dedup import substring_dedup
from kithwork.llm.tables import table
from kithwork.llm.token_alignment import alignment_report, token_alignment
from kithwork.llm.toxicity import toxicity


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"))
    spans = F.transform("removed", lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string")))
    return found.withColumn("removed", F.array_join(spans, ","))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(token_alignment(table(spark, sf_dir, "documents")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(periodic_runs(planted(table(spark, sf_dir, "documents"))))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(remove_repeated_bytes(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality": op5_quality,
    "op6_html_extraction": op6_html_extraction,
    "op7_decontamination": op7_decontamination,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_packing": op9_packing,
    "op10_language_id": op10_language_id,
    "op11_token_alignment": op11_token_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_suffix_array_dedup": op13_suffix_array_dedup,
}
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x20\x09-\x0D]+"

# ``links`` (x, y), both ways, and ``nodes`` (id) are given: the smallest id reachable.
REACHED = """
reach(id, other) as (select id, id from nodes union select r.id, l.y from reach r join links l on l.x = r.other),
lowest as (select id, min(other) as component_id from reach group by id)"""

ORACLES: dict[str, str] = {
    "op1_embedding_dedup": f"""
with recursive valid as (
  select vec_id, label, cast(embedding as double[]) as v from embeddings
  where label is not null and len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0),
links as materialized (
  select a.vec_id as x, b.vec_id as y from valid a join valid b
    on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= 0.93),
nodes as (select vec_id as id from embeddings), {REACHED}
select id as vec_id, (select count(*) from links where x = id) as n_links, component_id, component_id = id as kept from lowest""",
    "op3_minhash_dedup": f"""
with recursive split as (select doc_id, regexp_extract_all({LOWERED}, '{WORD}') as w from documents),
shingles as materialized (
  select doc_id, unnest(list_distinct(case when len(w) >= 5 then [array_to_string(w[i:i+4], chr(10)) for i in range(1, len(w) - 3)]
    when len(w) > 0 then [array_to_string(w, chr(10))] else [] end)) as s from split),
sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as x, b.doc_id as y, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as materialized (select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 85 * (p.n + q.n - c)),
nodes as (select doc_id as id from documents), {REACHED}
select id as doc_id, coalesce(n, 0) as n_shingles, component_id, component_id = id as kept from lowest left join sizes on doc_id = id""",
    "op4_substring_dedup": f"""
with cut as (select doc_id, regexp_extract_all(text, '(?s).*?(?:\\n|[.!?] )|.+') as units from documents where text is not null),
unit as (select doc_id, unnest(units) as text, unnest(range(1, len(units) + 1)) as k from cut),
placed as (
  select doc_id, k, text, cast(sum(length(text)) over (partition by doc_id order by k) as bigint) as stop,
    regexp_extract_all({LOWERED}, '{WORD}') as w from unit),
ranked as (
  select *, len(w) >= 5 and row_number() over (partition by w order by doc_id, k) > 1 as gone from placed),
whole as (
  select doc_id, string_agg(text, '' order by k) filter (where not gone) as text,
    string_agg((stop - length(text)) || '-' || stop, ',' order by k) filter (where gone) as removed, count(*) filter (where gone) as n_removed
  from ranked group by doc_id)
select d.doc_id, case when d.text is not null then coalesce(w.text, '') end as text, coalesce(removed, '') as removed,
  cast(coalesce(n_removed, 0) as int) as n_removed from documents d left join whole w on w.doc_id = d.doc_id""",
}
