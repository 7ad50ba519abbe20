"""Report enrichment as Spark jobs: DataFrame in, DataFrame out."""

__version__ = "0.1.0"
