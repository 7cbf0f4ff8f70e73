"""Daily price bars, volatility features and forecasts on Spark DataFrames."""
