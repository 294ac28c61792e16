"""Whole runs: the model sweep, the full run over season files, and the
queries over the driver tables with their DuckDB SQL."""
