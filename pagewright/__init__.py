"""pagewright: a PySpark-native engine that turns document corpora into retrieval queries.

Every operator is a DataFrame-to-DataFrame function; see README.md for the map.
"""

__version__ = "0.1.0"
