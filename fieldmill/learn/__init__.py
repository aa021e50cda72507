"""Encoders, model pipelines, search and evaluation."""
