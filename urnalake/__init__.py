"""Election-turnout lakehouse on Spark: bronze and silver tables, reports, quality and audit."""

__version__ = "0.1.0"
