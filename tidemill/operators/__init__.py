"""DataFrame -> DataFrame operators grouped by area."""
