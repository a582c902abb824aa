"""The shape of the physical plans."""

import io
import re
from contextlib import redirect_stdout

import pytest

from chatprep.plans import QUERIES
from tests.oracle import DATA

SF = str(DATA / "sf0.001")
PYTHON = {"batch_generate", "evaluate_conversations"}
# One record per document or turn in, rows out: these need no exchange at all.
NO_EXCHANGE = {
    "csv_to_chat", "alpaca_to_chat", "alpaca_format_strict", "ensure_system", "prepend_system",
    "build_chat", "append_turn", "render_chat", "render_prompt", "preprocess_dataset",
    "format_preset", "gsm8k_to_chat", "gsm8k_gold", "gsm8k_adapter_prompt", "validate_chat",
    "filter_nonempty_text", "filter_numeric_metrics", "clean_text", "extract_sections",
    "chunk_text", "filter_useful_chunks", "limit_chunks_per_doc", "make_training_examples",
    "make_training_examples_by_line", "chunk_topic", "examples_per_doc", "eval_pairs",
    "tokens_per_second", "response_length", "coherence_score", "keyword_flags", "extract_answer",
    "extract_answer_documents", "extract_boxed", "extract_first_of", "log_metrics",
    "flatten_hparams", "merge_run_config",
}


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(query(spark, SF)) for name, query in QUERIES.items()}


def test_no_cross_joins(plans):
    assert not [n for n, p in plans.items() if "NestedLoop" in p or "CartesianProduct" in p]


def test_python_only_where_the_caller_plugs_in(plans):
    assert {n for n, p in plans.items() if re.search(r"EvalPython|InPandas|InArrow", p)} == PYTHON


def test_projections_do_not_shuffle(plans):
    assert not [n for n in NO_EXCHANGE if "Exchange" in plans[n]]


def test_scans_read_only_what_they_need(plans):
    assert "ReadSchema: struct<doc_id:bigint>" in plans["split_counts"]
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plans["clean_text"]
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderpriority:string>" in (
        plans["extract_answer"]
    )


def test_source_filter_reaches_the_scan(plans):
    assert re.search(r"PushedFilters: \[In\(source", plans["mix_datasets"])
