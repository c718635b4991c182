"""Small helpers of the tests."""

from datetime import datetime


def ts(text):
    return None if text is None else datetime.fromisoformat(text)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)
