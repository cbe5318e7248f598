"""sluice: a Spark-native sensor lakehouse (bronze -> silver -> gold) built from
DataFrame and Structured Streaming operators."""

__version__ = "0.1.0"
