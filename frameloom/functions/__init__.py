"""Part of frameloom: functions."""
