"""lacuna: missingness-aware feature building for irregular event series on Spark.

Every operator takes and returns a ``DataFrame``; nothing is collected on the
driver.  See the README for the list of operators and the scaling notes.
"""
