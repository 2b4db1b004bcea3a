"""Sources of position records."""
