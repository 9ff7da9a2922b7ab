"""All registered cases."""

from __future__ import annotations

from verify import chart_cases, data_cases, quality_cases, report_cases

CASES = [*data_cases.CASES, *quality_cases.CASES, *report_cases.CASES, *chart_cases.CASES]
