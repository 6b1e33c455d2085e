"""eventlens.functions."""
