"""palmleaf: a PySpark-native engine for curating bilingual dictionary and instruction data."""

__version__ = "0.1.0"
