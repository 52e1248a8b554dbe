"""DataFrame operators: dimensions, fact, star aggregation, ranking, loading."""
