"""Column-level helpers: null rules, rounding, dates, people and labels."""
