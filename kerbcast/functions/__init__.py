"""Column helpers and distributed order statistics."""
