"""Registered queries: each is a Spark plan with its reference SQL."""
