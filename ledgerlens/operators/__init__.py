"""Reports, de-duplication, quality/reconciliation and migration operators."""
