"""gpsweave: fleet telemetry analytics on Spark (batch and Structured Streaming)."""

__version__ = "0.1.0"
