"""Readers, feed adapters, versioned tables and exports."""
