"""placeweave: point-of-interest matching, enrichment and reporting on Spark.

Every public function takes and returns ``DataFrame`` or ``Column`` objects;
nothing collects data to the driver.
"""

__version__ = "0.1.0"
