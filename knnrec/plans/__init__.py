"""End-to-end plans (exact and approximate kNN) and the query registry."""
