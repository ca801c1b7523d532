"""Times for the tests. No test imports from a conftest module, as several folders have one."""

from datetime import datetime, timezone


def utc(year, month, day, hour=0, minute=0, second=0):
    return datetime(year, month, day, hour, minute, second, tzinfo=timezone.utc)
