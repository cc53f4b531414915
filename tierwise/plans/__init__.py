"""Composed plans: the pipeline, the invoice model over the driver's tables,
and the catalog of registered queries with their SQL oracles."""
