"""placeflow: Spark-native operators for building clean, de-duplicated place tables.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a source /
sink taking a path); nothing here creates a session, collects data or runs an
action unless its name says so (``write_*``, ``export_*``).
"""

__all__ = ["session"]
