"""Threat-intelligence graph analytics expressed as Spark DataFrame jobs."""
