"""gridpanel: country-by-year panels from gridded data and indicator tables, on Spark."""

__version__ = "0.1.0"
