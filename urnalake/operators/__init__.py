"""DataFrame to DataFrame operators."""

from urnalake.operators import audit, quality, ranking, rollups, selection, silver

__all__ = ["audit", "quality", "ranking", "rollups", "selection", "silver"]
