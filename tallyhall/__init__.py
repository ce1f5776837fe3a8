"""tallyhall — Spark-native star-schema cleaning, conforming and KPI engine.

Every operator takes a DataFrame plus column names and returns a DataFrame;
nothing is collected to the driver. See README.md for the module map.
"""

__version__ = "0.1.0"
