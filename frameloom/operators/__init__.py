"""Part of frameloom: operators."""
