"""Readers, the HTML grid parser, sinks and the provider protocol."""
