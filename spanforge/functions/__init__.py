"""functions of the interval and sequence engine."""
