"""DataFrame-in, DataFrame-out mining operators."""
