"""Device-fleet telemetry analytics on Spark.

Operators are plain ``DataFrame -> DataFrame`` functions; see the README for
the map of modules.
"""
