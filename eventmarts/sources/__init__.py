"""Readers: bronze trees, raw CSV, the event stream, marts, and the driver binding."""
