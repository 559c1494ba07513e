"""Bronze / silver / gold analytics over daily equity prices and dividends, on Spark DataFrames."""
