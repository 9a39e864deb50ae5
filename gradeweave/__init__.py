"""Schedule reconciliation as DataFrame transformations on Spark."""
