"""Operators over site, annotation, pileup, sequence and read tables."""
