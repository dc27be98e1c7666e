"""Part of frameloom: streaming."""
