"""marginflow: supplier and product profitability analytics on Spark.

Every operator takes and returns DataFrames. Nothing is collected to the
driver except fitted-model scalars (KMeans cost, regression coefficients).
"""

__version__ = "0.1.0"
