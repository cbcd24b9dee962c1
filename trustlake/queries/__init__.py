"""The queries the driver runs, each with the SQL that must give the same rows."""

from trustlake.queries import bindings, extraction, layers, modelling, quality
from trustlake.queries.catalogue import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "bindings", "extraction", "layers", "modelling", "quality"]
