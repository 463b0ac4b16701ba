"""namavali: a PySpark-native engine that turns Devanagari page text into clean name tables."""

__version__ = "0.1.0"
