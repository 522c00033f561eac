"""Readers, payload flattening, guarded table replacement and bounded reads."""
