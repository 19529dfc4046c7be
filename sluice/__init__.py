"""Sluice: DataFrame-first curation, splitting, packing and monitoring of media catalogs."""
