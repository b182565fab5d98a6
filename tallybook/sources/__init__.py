"""Readers, record ids, manifest check, sinks and the shop-shaped input views."""
