"""Part of frameloom: sources."""
