"""Projection of the test tables onto the billing model, and the SQL that checks every query."""
