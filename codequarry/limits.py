"""Bounds of the corpus jobs. None, the default for whatever would drop data, is no bound."""

from __future__ import annotations

from dataclasses import dataclass

from codequarry import fixed_values as V


@dataclass(frozen=True)
class Limits:
    file_bytes: int | None = None
    repository_files: int | None = None
    repository_bytes: int | None = None
    question_chars: int | None = None
    module_path_chars: int = 512
    hits: int = 8
    entity_rows: int = 100
    graph_rows: int = 200
    graph_rows_max: int = 500
    page_rows: int = 20
    page_rows_max: int = 100
    retention_days: int = 30
    requests_per_window: int = 60
    window_seconds: int = 60
    tree_depth: int | None = None
    # Bytes of a file that decide whether it is binary.
    binary_header_bytes: int | None = None
    # Of the text that a row of `entities` shows for Python sources; facts and chunks hold it whole.
    module_chars: int | None = None
    block_chars: int | None = None
    # Of a hit shown in a context, of one in a summary, and of a snippet in an offline answer.
    hit_chars: int | None = V.HIT_CHARS
    summary_chars: int | None = V.SUMMARY_CHARS
    answer_chars: int | None = V.ANSWER_CHARS
    answer_snippets: int | None = V.ANSWER_SNIPPETS


DEFAULT_LIMITS = Limits()
# The bounds of the service that these jobs follow, for whoever wants its cuts.
SERVICE_LIMITS = Limits(
    file_bytes=512 * 1024, repository_files=5000, repository_bytes=500 * 1024 * 1024,
    question_chars=2000, tree_depth=6, binary_header_bytes=V.BINARY_HEADER_BYTES,
    module_chars=V.MODULE_CHARS, block_chars=V.BLOCK_CHARS,
)
