"""DataFrame operators: cleaning, features, ranking, warehouse, time series, forecasting."""
