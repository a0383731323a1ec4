"""The two load pipelines and the dashboard reads."""
