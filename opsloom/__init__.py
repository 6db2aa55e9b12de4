"""Spark DataFrame operators that prepare operations data for incident-response models."""
