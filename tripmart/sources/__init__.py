"""Readers and writers: trip files, zone dimension, month spine, result tables."""
