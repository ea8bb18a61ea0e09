"""Writers: bronze trees, keyed records, marts."""
