"""metroscope: city-signal analytics (311 requests, weather, alerts, news) as Spark plans."""

__version__ = "0.1.0"
