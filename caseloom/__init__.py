"""Spark table operators that turn noisy extracted records into reviewable cases."""

__version__ = "0.1.0"
