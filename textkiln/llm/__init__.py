"""Operators for building training corpora: deduplication, decontamination,
mixing, filters, vector search and main-text extraction."""
