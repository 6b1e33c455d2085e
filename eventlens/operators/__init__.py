"""eventlens.operators."""
