"""Spark jobs that clean, key, summarise, link and rank catalogue and certification tables."""
