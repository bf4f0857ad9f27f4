"""Retention pipeline on Spark: labels, model, daily scores, campaign copy, outbox."""
