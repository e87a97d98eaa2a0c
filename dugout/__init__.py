"""dugout: composable PySpark DataFrame operators for event / entity / time data."""

__version__ = "0.1.0"
