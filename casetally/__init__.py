"""Court and case-management statistics as lazy Spark DataFrame operators."""

__version__ = "0.1.0"
