"""Job compositions and the query catalog."""
