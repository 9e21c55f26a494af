"""Operators for large training corpora (deduplication, language
identification, quality, mixing, packing, search, chat formatting).  Nothing else
in the library imports this subpackage."""
