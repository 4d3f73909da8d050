"""Column and statistic helpers shared by the operators."""
