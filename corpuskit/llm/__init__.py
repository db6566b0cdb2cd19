"""Operators that a training-data pipeline needs beside the corpus builder."""
