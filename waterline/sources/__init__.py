"""Readers and writers: catalog feeds, collector output, snapshot facts, assets and reports."""
