"""sources of folioframe."""
