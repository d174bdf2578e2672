"""The feature catalogue and the plans that combine operators."""
