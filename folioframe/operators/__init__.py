"""operators of folioframe."""
