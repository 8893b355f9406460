"""Training-data operators: one module an operator, and `registry` with their queries."""
