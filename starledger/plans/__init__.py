"""Composed jobs: the clean model, the enriched view, the batch run and the
named query catalogue."""
