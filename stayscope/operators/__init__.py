"""DataFrame operators, grouped by what they are for."""
