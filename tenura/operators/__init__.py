"""Generic DataFrame operators; none knows a concrete table."""
