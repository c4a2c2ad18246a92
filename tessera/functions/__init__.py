"""Part of tessera."""
