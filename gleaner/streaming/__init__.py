"""Streams of fetch jobs: ingest, deduplication, admission, rate limits, retries."""
