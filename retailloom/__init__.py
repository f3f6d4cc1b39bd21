"""Omnichannel retail analytics as plain DataFrame functions on PySpark."""
