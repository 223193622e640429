"""tidewater: vessel, port and ocean-weather analytics as Spark DataFrame jobs.

Layout
------
sources/    catalogs, store scans, landed-payload readers, test fixtures, Kafka
functions/  column expressions: sentinel cleaning, casts, rounding, bands, geo
operators/  DataFrame -> DataFrame building blocks: latest-per-key, upsert,
            cells <-> rows, latest-run / recent filters, profiles
plans/      the reports (weather, fleet, movement) and ingest transforms
streaming/  AIS decode, reject routing, replay-safe keys, windowed counts
sinks.py    report writer, keyed upsert store, Kafka publisher
"""

from tidewater.session import checkpoint_root, get_session

__all__ = ["get_session", "checkpoint_root"]
