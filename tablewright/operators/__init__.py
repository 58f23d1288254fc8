"""The operators: plain functions from tables (and models) to tables."""
