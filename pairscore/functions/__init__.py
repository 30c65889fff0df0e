"""Column functions: text normalisation, response parsing, metrics."""
