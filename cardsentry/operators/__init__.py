"""Relational operators: sizing, versioned dimensions, enrichment, detections."""
