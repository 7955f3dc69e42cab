"""Scans of transcript documents, tables and media, and the download step."""
