"""salesplane: a Spark-native sales feature, forecasting and evaluation engine."""

__version__ = "0.1.0"
