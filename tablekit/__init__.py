"""tablekit — composable ``DataFrame -> DataFrame`` operators on Spark.

Sub-packages:

* ``sources``   — readers and writers (text, whole files, CSV, Parquet).
* ``operators`` — relational and keyed operators (shaping, joins, sets,
  aggregation, ordering, sampling).
* ``functions`` — column-expression builders (text, n-grams, fuzzy
  matching, sequences, vectors, special functions).
* ``plans``     — multi-step plans (statistics, pair features, recommender,
  model fitting) and the registered queries with their SQL oracles.
* ``streaming`` — the same operators applied to streaming DataFrames.
"""

__version__ = "0.1.0"
