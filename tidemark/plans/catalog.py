"""All registered queries and the SQL they are checked against."""

from __future__ import annotations

from tidemark.plans import (
    catalog_drift,
    catalog_explain,
    catalog_features,
    catalog_io,
    catalog_prep,
    catalog_profile,
    catalog_scores,
    catalog_train,
)

_PARTS = [
    catalog_profile,
    catalog_features,
    catalog_scores,
    catalog_drift,
    catalog_explain,
    catalog_prep,
    catalog_train,
    catalog_io,
]

QUERIES = {name: fn for part in _PARTS for name, fn in part.REGISTRY.queries.items()}
ORACLE = {name: sql for part in _PARTS for name, sql in part.REGISTRY.sql.items()}
