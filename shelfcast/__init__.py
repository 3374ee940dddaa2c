"""Daily retail demand: panel, features, folds, forecasts, scores and monitoring as Spark DataFrames."""
