"""All reports; importing the modules registers them."""

from . import (  # noqa: F401
    analytics_reports, document_reports, event_reports, metric_reports, mutation_reports, record_reports, stream_reports,
    vector_reports,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
