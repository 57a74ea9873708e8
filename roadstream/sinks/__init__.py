"""Writers: append-only tables, once-per-day violations, vehicle tracks."""
