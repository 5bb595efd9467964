"""Operators: functions from DataFrame to DataFrame; none of them collects."""
