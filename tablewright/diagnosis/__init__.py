"""Diagnosis of finished runs, from the event logs of many applications."""
