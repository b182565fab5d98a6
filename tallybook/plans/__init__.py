"""Data quality, reconciliation, star schema, KPI, forecast and sampling plans."""
