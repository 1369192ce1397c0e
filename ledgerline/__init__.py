"""ledgerline: retail sales / profit / discount analytics on PySpark.

Load a sales fact (flat CSV or star-schema binding), clean it, and compute
grouped reports, KPIs, rankings, chart series and a ridge-regression model,
all as Spark DataFrames.
"""

__version__ = "0.1.0"
