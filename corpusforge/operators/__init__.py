"""Table-to-table steps, each ``f(df, ...) -> df``."""
