"""Schemas, table and message sources and sinks."""
