"""measurekit: cleaning, measurement statistics and model evaluation as Spark jobs."""

__version__ = "0.1.0"
