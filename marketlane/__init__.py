"""marketlane: a PySpark-native shop-analytics engine.

Dirty daily CSV partitions become typed core tables with quarantine, then
denormalised facts, daily marts and business reports.  Every step is a
``DataFrame -> DataFrame`` function that Spark partitions and shuffles.
"""
