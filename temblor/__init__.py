"""temblor: Spark-native seismic-event analytics (batch, streaming, model)."""

__version__ = "0.1.0"
