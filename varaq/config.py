"""Settings of the document engine; the values are part of its results."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    line_band: float = 3.0
    size_ratio_strong: float = 1.5
    size_ratio_weak: float = 1.15
    score_strong: float = 0.5
    score_weak: float = 0.25
    score_colour: float = 0.35
    score_bold: float = 0.15
    score_long: float = -0.4
    heading_score: float = 0.5
    long_line: int = 100
    grey_tolerance: float = 0.08
    default_size: float = 12.0
    table_rows: int = 2
    table_cols: int = 2
    table_fill: float = 0.5
    title_chars: int = 60
    false_table_area: float = 0.5
    false_table_newlines: int = 15
    exclusion_slack: float = 1.0
    min_chars: int = 30
    max_pages: int = 5000
    low_confidence: float = 45.0
    toc_label_prefix: int = 15
    default_confidence: float = 0.7
    caption_chars: int = 2000
    caption_value_chars: int = 200
    queue_capacity: int = 10
    retention_hours: int = 24
    timeout_seconds: int = 7200
    status_seconds: int = 5
    zip_above: int = 4
    shown_warnings: int = 8
    warning_chars: int = 180
    max_file_bytes: int = 1900 * 1024 * 1024


SETTINGS = Settings()
