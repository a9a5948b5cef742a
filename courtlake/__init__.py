"""Spark jobs for building, checking and searching a catalogue of court decisions."""
