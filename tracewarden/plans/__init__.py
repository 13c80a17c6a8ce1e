"""Whole plans: the batch pipeline and the registered queries."""
