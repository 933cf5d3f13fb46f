"""Readers, sinks and generated relations."""
