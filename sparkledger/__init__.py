"""sparkledger: Spark-native operators for turning messy spend feeds into governed tables.

Operators are plain functions ``DataFrame -> DataFrame`` or ``-> Column`` built from
Spark's own DataFrame API; see the README for the catalogue.
"""

__version__ = "0.1.0"
