"""Operators for preparing training text at scale.

Nothing outside this folder imports it; `queries` holds what the registry picks up.
"""
