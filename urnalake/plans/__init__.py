"""Jobs that put sources and operators together."""

from urnalake.plans.bronze import ingest
from urnalake.plans.lake import Lake
from urnalake.plans.reports import export_samples, report, report_of
from urnalake.plans.silver import build_silver

__all__ = ["Lake", "build_silver", "export_samples", "ingest", "report", "report_of"]
