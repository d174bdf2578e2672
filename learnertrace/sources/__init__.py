"""Where activity tables come from and where feature tables go."""
