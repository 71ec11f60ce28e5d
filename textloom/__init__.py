"""Annotated-text analytics on Spark: spans, mapping, pseudonymisation, audits."""
