"""Operators: staging, historical transform, sessions, marts, reports, quality."""
