"""Every registered query of the subpackage on the smallest given tables: columns, one row per input row."""

import os
import subprocess
import sys
import textwrap

import pytest

import oracle_check
from kithwork.llm.queries import ORACLES, QUERIES
from kithwork.llm.tables import table

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CONTRACTS = {
    "op1_embedding_dedup": ("embeddings", "vec_id n_links component_id kept"),
    "op2_toxicity": ("documents", "doc_id held_out score predicted"),
    "op3_minhash_dedup": ("documents", "doc_id n_shingles component_id kept"),
    "op4_substring_dedup": ("documents", "doc_id text removed n_removed"),
    "op5_quality": ("documents", "doc_id held_out score predicted"),
    "op6_html_extraction": ("pages", "page_id url text n_chars"),
    "op7_decontamination": ("documents", "doc_id contaminated item_id coverage n_items"),
    "op8_lm_scoring": ("documents", "doc_id held_out n_tokens n_known train_tokens base_score score"),
    "op10_language_id": ("documents", "doc_id held_out lang_pred score"),
    "op11_token_alignment": ("documents", "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256"),
    "op12_periodic_runs": ("documents", "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256"),
    "op13_suffix_array_dedup": ("documents", "doc_id n_bytes n_removed n_spans kept_sha256"),
}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_columns_and_rows(spark, name):
    source, columns = CONTRACTS[name]
    found = QUERIES[name](spark, SF)
    assert found.columns == columns.split()
    assert found.count() == table(spark, SF, source).count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, name):
    assert oracle_check.difference(QUERIES[name](spark, SF), oracle_check.connect(SF), ORACLES[name]) is None


def test_all_queries_have_a_number():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_entry_works_without_the_subpackage():
    code = """
        import sys
        for name in ("corpus_pipeline", "kithwork.llm"):
            sys.modules.pop(name, None)
        class Gone:
            def find_spec(self, name, path=None, target=None):
                if name in ("corpus_pipeline", "kithwork.llm"):
                    raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as e
        assert "word_count" in e.queries() and not any(n.startswith("op") or n == "pipeline" for n in e.queries())
        assert set(e.oracle_sql()) <= set(e.queries())
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=ROOT, check=True, timeout=100)
