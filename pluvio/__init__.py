"""pluvio — gridded rainfall forecasts to flash-flood figures per catchment, on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions; no driver-side loops, no row-at-a-time Python on the main path.
Times are UTC instants (``TimestampType``); the session time zone must be UTC
(``pluvio.session.ensure_utc``).
"""

__version__ = "0.1.0"
