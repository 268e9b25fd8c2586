"""End-to-end pipelines and the query registry."""
