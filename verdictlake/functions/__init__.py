"""Column functions: redaction, canonical JSON, text formats, provenance."""
