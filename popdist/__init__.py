"""popdist: population-weighted distributions over coded catalogues, on Spark."""

__version__ = "0.1.0"
