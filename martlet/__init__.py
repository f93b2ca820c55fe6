"""martlet: a Spark-native marketplace mart.

Ingest relational tables and CSV files into staging, build a star schema
(customers, sellers, products, a minute calendar, order and order-item
facts), check keys, references and lifecycle rules as violation
DataFrames, and compute sales metrics -- all as DataFrame plans that
Catalyst optimizes and Spark executes in parallel.
"""

__version__ = "0.1.0"
