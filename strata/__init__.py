"""strata: a medallion (bronze / silver / gold) analytics engine for sensor event feeds on PySpark.

Every operator is a ``DataFrame -> DataFrame`` function. Keys, bounds, fills and thresholds
are arguments; the defaults are the presets of the traffic / weather domain.
"""

__version__ = "0.1.0"
