"""Frozen settings of the stages (fixed values)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RetryPolicy:
    retries: int = 2
    delay: float = 10.0
    jitter: float = 0.5
    timeout: float = 120.0


RETRIES = {
    "discover": RetryPolicy(delay=30.0, timeout=1000.0),
    "scrape": RetryPolicy(),
    "filter": RetryPolicy(timeout=60.0),
    "summarize": RetryPolicy(),
    "extract": RetryPolicy(),
    "categorize": RetryPolicy(),
    "graph": RetryPolicy(timeout=60.0),
}


@dataclass(frozen=True)
class Limits:
    max_pages: int = 5
    title_slug: int = 40
    topic_summary: int = 500
    report_rows: int = 5
    preview_tokens: int = 10_000
    summary_tokens: int = 30_000
    html_sample: int = 30_000


LIMITS = Limits()
