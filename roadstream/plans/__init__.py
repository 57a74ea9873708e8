"""Complete jobs, and the query catalog over the driver's tables."""
