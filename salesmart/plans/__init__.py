"""Named queries: each pairs a Spark plan with an independent SQL oracle."""

from salesmart.plans import analytics, ingest, marts, models, quality, reports, streams

ALL_MODULES = (marts, quality, analytics, reports, ingest, models, streams)
