"""creamery: a medallion (bronze -> silver -> gold) analytics library on Spark."""

__version__ = "0.1.0"
