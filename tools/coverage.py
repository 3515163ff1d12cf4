"""Build COVERAGE.md: SURVEY §2 inventory ids -> registered queries and tests.

    python tools/coverage.py > COVERAGE.md

Ids are read from the query docstrings (e.g. "(A1, B6)") and from the ids
named in test docstrings/comments; fixture-only rows (F) point at tests.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

ID_RE = re.compile(r"\b([A-L][0-9]{1,2}|G-U[0-9])\b")

# Rows verified by pytest fixtures rather than (or in addition to) a driver-table query.
FIXTURE_TESTS = {
    "A2": "test_io_hooks.py::test_jsonl_permissive_quarantine",
    "A5": "test_io_hooks.py::test_writer_skips_empty_and_splits_files",
    "A6": "test_io_hooks.py::test_jsonl_permissive_quarantine (format switch)",
    "A12": "test_threads.py::test_thread_edge_documents",
    "A13": "test_listing.py::test_post_detail_not_filtered",
    "A18": "test_io_hooks.py::test_summary_json",
    "B2": "test_threads.py::test_full_flatten",
    "B3": "test_threads.py::test_slim_flatten_prunes_subtrees",
    "B19": "test_listing.py::test_quarantine_keeps_good_rows",
    "D11": "test_threads.py::test_more_placeholders_counted",
    "H1": "test_threads.py::test_full_flatten",
    "H2": "test_threads.py::test_slim_flatten_prunes_subtrees",
    "A9": "test_reports.py::test_newest_file",
    "A16": "test_reports.py::test_inventory_counts_what_lies_there",
    "A17": "test_index_table.py::test_edited_shortened_unchanged_emptied_and_late",
    "D3": "test_reports.py::test_write_reports_rows_without_reading_again",
    "G5": "test_index_table.py::test_chunking_is_linear_in_the_length",
    "G-U2": "test_threads.py::test_deep_chain_takes_logarithmic_rounds",
    "H4": "test_threads.py::test_path_text_keeps_long_positions_apart_and_in_order",
    "I6": "test_retrieval.py::test_cells_reach_their_recall_on_driver_vectors",
    "I7": "test_retrieval.py::test_bm25_index_skips_blocks_and_serves_many_batches",
    "I12": "test_dedupe_streams.py::test_near_duplicates_equal_brute_force",
    "J1": "test_reports.py::test_job_of_a_url_is_not_left_to_chance",
    "K1": "test_index_table.py::test_untouched_buckets_keep_their_files",
    "K4": "test_dedupe_streams.py::test_late_rows_are_kept_apart_and_state_expires",
    "K5": "test_dedupe_streams.py::test_stream_index_jsonl_quarantines_bad_lines",
    "K8": "test_io_hooks.py::test_writer_skips_empty_and_splits_files",
    "K9": "test_dedupe_streams.py::test_stalled_jobs_by_timers",
    "L1": "test_io_hooks.py::test_models_are_built_once_a_worker",
    "L2": "test_io_hooks.py::test_model_hooks",
    "L3": "test_io_hooks.py::test_model_hooks",
}

SURVEY_IDS = (
    [f"A{i}" for i in range(1, 19)] + [f"B{i}" for i in range(1, 21)] + [f"C{i}" for i in range(1, 10)]
    + [f"D{i}" for i in range(1, 14)] + [f"E{i}" for i in range(1, 6)] + [f"F{i}" for i in range(1, 8)]
    + [f"G-U{i}" for i in range(1, 5)] + [f"G{i}" for i in range(1, 19)] + [f"H{i}" for i in range(1, 6)]
    + [f"I{i}" for i in range(1, 13)] + [f"J{i}" for i in range(1, 14)] + [f"K{i}" for i in range(1, 10)]
    + [f"L{i}" for i in range(1, 4)]
)


def main() -> None:
    from threadmill.plans import registry

    qs, sql = registry.queries(), registry.oracle_sql()
    by_id: dict[str, list[str]] = {}
    for name, fn in qs.items():
        groups = re.findall(r"\(([^()]*)\)", fn.__doc__ or "")
        for i in {x for g in groups for x in ID_RE.findall(g)}:
            by_id.setdefault(i, []).append(name)
    print("# Coverage of the SURVEY §2 inventory\n")
    print(f"{len(qs)} registered queries, {len(sql)} with DuckDB oracle SQL "
          "(`Y` = oracle-checked, `R` = rows-only). Fixture tests live in `tests/`.\n")
    print("| Id | Registered queries | Tests |\n|---|---|---|")
    missing = []
    for i in SURVEY_IDS:
        names = sorted(by_id.get(i, []))
        cell = ", ".join(f"`{n}` ({'Y' if n in sql else 'R'})" for n in names)
        test = FIXTURE_TESTS.get(i, "")
        if not cell and not test:
            missing.append(i)
        print(f"| {i} | {cell or '—'} | {test} |")
    if missing:
        print(f"\nNot referenced by any query docstring or fixture test: {', '.join(missing)}")


if __name__ == "__main__":
    main()
