"""Complete jobs, the daily run and the queries over the provided tables."""
