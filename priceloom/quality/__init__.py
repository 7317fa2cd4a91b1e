"""Checks, severities, freshness, build parity."""

from priceloom.quality.checks import (
    Check,
    QualityGateError,
    accepted,
    failing_rows,
    holds,
    not_after,
    not_null,
    raise_on_errors,
    refers_to,
    run_checks,
    unique,
)
from priceloom.quality.drift import format_drift
from priceloom.quality.freshness import freshness
from priceloom.quality.parity import compare_builds, differing_partitions, fingerprint, profile

__all__ = [
    "Check", "QualityGateError", "accepted", "compare_builds", "differing_partitions", "failing_rows", "fingerprint",
    "format_drift", "freshness", "holds", "not_after", "not_null", "profile", "raise_on_errors", "refers_to", "run_checks", "unique",
]
