from ordermetrics.plans.catalog import flagship, query_catalog
from ordermetrics.plans.oracle import oracle_catalog
from ordermetrics.plans.reconciliation import (
    Reconciliation, reconcile, reconcile_tables, write_reconciliation,
)

__all__ = [
    "Reconciliation", "flagship", "oracle_catalog", "query_catalog", "reconcile",
    "reconcile_tables", "write_reconciliation",
]
