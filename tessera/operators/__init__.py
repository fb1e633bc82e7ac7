"""DataFrame -> DataFrame operators (aggregation, ranking, similarity, quality, catalog)."""
