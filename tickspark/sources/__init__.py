"""Readers, decoders and sinks."""
