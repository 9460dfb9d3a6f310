"""Readers, schema, artefact tables and sinks."""
