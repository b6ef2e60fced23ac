"""The jobs applied to the driver tables: dirty input views, queries, and their SQL counterparts."""
