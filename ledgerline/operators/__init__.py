"""Analytics operators: every function maps a sales-fact DataFrame to a
result DataFrame using built-in Spark SQL expressions only."""
