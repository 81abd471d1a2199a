"""Experiment analytics on Spark: user outcomes, summaries, effect estimates, rollout decisions."""
