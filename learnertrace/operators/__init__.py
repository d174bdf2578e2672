"""Feature, cohort, model and evaluation operators."""
