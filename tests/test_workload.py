"""A sample of the registered queries against their SQL; ``oracle.py`` runs all."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, connect  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SAMPLE = ("w1_rank_papers", "k2_split_top", "a3_edition_totals", "a16_set_digest", "p5_check_evidence", "p11_primary_only",
          "j2_verify_metadata", "j16_walk_chain", "u3_set_diff", "h1_normalize_prose", "b12_plan_entries", "r1_retry_state", "y2_audit_language_groups", "a8_score_plateau", "s10_write_edition", "s11_write_immutable",
          "s12_publish", "s13_append_event", "s14_complete_set", "s17_write_source_text", "s16_check_bundle", "j4_match_authors", "w2_check_rank", "r6_publication_stream",
          "s1_report_file_issues", "s2_read_editions", "s5_run_policy", "s7_read_archives", "s8_read_events", "s9_audit_files", "u1_union_records", "s14_export_refused", "j17_verify_plan",
          "j18_verbatim_reuse", "j18_row_verbatim_reuse", "j19_shingle_coverage", "a12_template_repeats", "a20_default_rules", "q3_allowed_tokens", "b8_select_authorized", "p24_check_selection_evidence",
          "p14_validate_by_version", "y1_audit_structure", "r8_new_dates_stream", "r9_import_stream")


@pytest.fixture(scope="module")
def con():
    if not Path(FOLDER).exists():
        pytest.skip("the supplied tables are not here")
    return connect(FOLDER)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, con, name):
    rows, problem = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER)
    assert problem is None and rows >= 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert "rank" in entry.entry(spark).columns
