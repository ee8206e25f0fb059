"""Analytics over repository documentation and source code, and over training text, on Spark."""
