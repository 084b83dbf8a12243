"""streaming of folioframe."""
