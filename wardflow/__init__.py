"""wardflow: Spark-native admission analytics.

Cleaning, medical-code translation, clinical feature derivation, profiling,
classifier training and evaluation, all as lazy DataFrame functions.
"""

__version__ = "0.1.0"
