"""Structured Streaming forms of the analyses.

Keyed state lives in the RocksDB state store through ``transformWithState``. Station keys carry many rows per
micro-batch and are handled as pandas frames; unit and visit keys carry a handful and are handled row by row.
"""
