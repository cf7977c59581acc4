"""Answers to requests, the binding to the driver's tables and the query registry."""
