"""Relational operators of the pipeline (dedupe, ids, quality gates, frame shaping)."""
