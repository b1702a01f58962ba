"""Query plans: the curated seismic questions and their driver-table variants."""
