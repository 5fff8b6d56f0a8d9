"""Spark-native document intelligence: chunks, triage, people, timelines, threads and a case graph."""
