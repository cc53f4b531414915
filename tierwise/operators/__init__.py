"""DataFrame operators: joins, totals, validation, reshaping and reuse."""
