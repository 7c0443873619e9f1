"""DataFrame operators: de-duplication, history, temporal joins, metrics, checks."""
