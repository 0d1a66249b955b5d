"""Queries by area; importing this registers them all."""

from pagemill.catalog import codecs, files, more, pages, records, relations, variants, words  # noqa: F401
