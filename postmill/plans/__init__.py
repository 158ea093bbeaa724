"""User-level jobs, input views and the query registry."""
