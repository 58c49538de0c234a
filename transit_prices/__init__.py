"""transit_prices: Spark-native analysis of how new rail stations move nearby
housing prices, and forecasts of those prices.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function that takes column names as parameters, so it composes with
``df.transform`` and runs unchanged on any table size.

Sub-packages
------------
sources    readers, sinks and the adapters that derive domain tables from the
           driver's TPC-H-like tables
functions  column expressions (text parsing, accent folding, haversine, ...)
operators  table operators: cleaning, geocoding, nearest station, panels,
           diff-in-diff, Double ML, splits, sequences, scaling, models
plans      composite pipelines and the registry of named queries
streaming  intentionally empty: the reference has no streaming work
"""

__version__ = "0.1.0"
