"""Weather-delay analytics on Spark: trips, observations, timelines, targets, models."""
