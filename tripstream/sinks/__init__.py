"""Sinks: landing files, keyed upserts, partitioned tables, audits."""
