"""ledgerlens: civic-spending analytics on Spark.

Raw public-finance, council-vote and survey data -> clean tables -> the
analytical views, all as DataFrame -> DataFrame functions built from native
Spark expressions.
"""

__version__ = "0.1.0"
