"""The registered text queries: their SQL, their columns, and the guard around them."""

import subprocess
import sys
from pathlib import Path

import pytest

from tallyhawk.llm.oracles import ORACLES
from tallyhawk.llm.queries import QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) == []


COLUMNS = {
    "op1_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2_html_text": "page_id bigint, url string, text string, n_chars bigint",
    "op3_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op5_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op7_repeats": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op9_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op10_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op11_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op12_divergence": "lang string, source string, part string, item string, value bigint, rank int",
    "op13_periods": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    types = dict(QUERIES[name](spark, SF_DIR).dtypes)
    assert {c: types[c] for c in (x.split()[0] for x in COLUMNS[name].split(", "))} == dict(x.split() for x in COLUMNS[name].split(", "))


@pytest.mark.parametrize("name", ["op4_licences", "op8_line_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop") if x in plan]


def test_the_rest_imports_without_these_folders(tmp_path):
    root = Path(__file__).resolve().parents[2]
    code = (
        "import sys\n"
        "class Hide:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('tallyhawk.llm') or name == 'corpus_pipeline': raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Hide())\n"
        f"sys.path.insert(0, {str(root)!r})\n"
        "import __spark_entry__ as e\n"
        "assert e.queries().keys() == e.oracle_sql().keys() and len(e.queries()) > 50\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, timeout=120)
