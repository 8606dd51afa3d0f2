"""DataFrame operators: dedup, profile, clean, checks, KPIs, serving, intake."""
