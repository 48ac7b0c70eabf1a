"""Procurement-notice analytics and general table operators on Spark DataFrames."""
