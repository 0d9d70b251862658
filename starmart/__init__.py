"""Star-schema mart pipelines, checks and analyses as Spark DataFrame plans."""

__version__ = "0.1.0"
