"""Registered queries by area, each with the SQL that gives the same rows."""

from . import answers, basics, changes, chunking, search

_AREAS = (basics, chunking, search, answers, changes)
QUERIES = {name: query for area in _AREAS for name, query in area.QUERIES.items()}
ORACLES = {name: sql for area in _AREAS for name, sql in area.ORACLES.items()}
flagship = answers.flagship
