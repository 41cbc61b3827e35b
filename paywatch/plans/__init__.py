"""Registered queries over the provided tables and their SQL counterparts."""
