"""Training-data operators over documents and pages (see queries.py)."""
