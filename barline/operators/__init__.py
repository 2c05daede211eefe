"""DataFrame operators over bars, features, forecasts and benchmark tables."""
