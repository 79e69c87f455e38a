"""Readers and the gated publisher."""
