"""Registry of the screening queries and their SQL."""

from . import q_audit, q_evidence, q_fusion, q_io, q_labels, q_models, q_rank, q_tables

QUERIES: dict = {}
ORACLES: dict = {}
for module in (q_rank, q_labels, q_fusion, q_audit, q_models, q_evidence, q_io, q_tables):
    QUERIES |= module.QUERIES
    ORACLES |= module.ORACLES
