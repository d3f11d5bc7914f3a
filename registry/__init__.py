"""Queries over the driver's tables, one per operator, and their SQL counterparts."""
