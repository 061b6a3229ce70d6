"""Composite plans a user calls: reports over the star schema, forecasting tables."""
