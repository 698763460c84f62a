"""Forecast-versus-outcome analytics over season records, as Spark DataFrame jobs."""
