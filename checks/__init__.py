"""Query registry: the operators over the given tables, with their SQL counterparts."""
