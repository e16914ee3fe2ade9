"""touchpath: Spark-native digital attribution and media-spend analysis.

Every operator is a ``DataFrame -> DataFrame`` function (composable with
``df.transform``) planned by Catalyst. Timestamps are UTC wall-clock
``TIMESTAMP_NTZ`` values derived from epoch microseconds, so no result depends
on ``spark.sql.session.timeZone``.
"""

from touchpath.config import ChainConfig, EventsConfig, MediaChannel, MediaConfig, WindowConfig

__all__ = ["ChainConfig", "EventsConfig", "MediaChannel", "MediaConfig", "WindowConfig"]
