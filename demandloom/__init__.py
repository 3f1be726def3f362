"""Demand-panel analytics and forecasting as Spark plans."""
