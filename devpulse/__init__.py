"""Compare what people say in surveys with what they do, on Spark."""
