"""Registered queries, their SQL oracles, and the multi-module build."""
