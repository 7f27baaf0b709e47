"""demandloom: retail demand features, datasets and forecasts as Spark jobs."""

__version__ = "0.1.0"
