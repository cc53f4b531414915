"""Column-level building blocks: aggregate metrics (``metrics``)."""
