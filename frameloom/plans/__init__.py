"""Part of frameloom: plans."""
