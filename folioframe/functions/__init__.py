"""functions of folioframe."""
