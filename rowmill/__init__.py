"""rowmill: preparation, classification and scoring of large tables on Spark.

Every operator is a function over DataFrames.  ``fit_*`` functions run one
bounded aggregation and return a small state; ``apply_*`` functions are plain
projections or filters, so they work on batch and on streaming frames alike.
"""
