"""tunelake: music-listening analytics on Spark.

Every operator is a function from DataFrames to a DataFrame. Scans and writes
live only in ``tunelake.sources``; ``tunelake.plans`` composes operators into
the user-level entry points; ``tunelake.plans.catalog`` registers the queries
checked against the SQL oracle.
"""

__version__ = "0.1.0"
