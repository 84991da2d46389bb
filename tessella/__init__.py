"""Documents and attribute tables to clean, segmented text, as Spark plans."""
