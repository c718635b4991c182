"""Layered (raw -> staging -> marts -> gold) analytics on PySpark."""

from stratalake.session import configure, estimated_bytes, shared_root, size_shuffles

__all__ = ["configure", "estimated_bytes", "shared_root", "size_shuffles"]
