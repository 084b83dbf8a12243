"""folioframe: document-evidence analytics on Spark DataFrames."""
