"""Record quarantine and reprocessing on Spark.

``functions`` builds columns, ``operators`` maps DataFrames to DataFrames, ``sources`` reads and
writes, ``plans`` composes whole jobs, ``streaming`` runs them on micro-batches, and ``catalog``
holds the queries the repository is checked with.
"""
