"""Column functions: cleaning, calendar and exact rounding."""
