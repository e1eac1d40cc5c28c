"""Operators for preparing training data: deduplication, language, quality, decontamination, mixing, ...

Nothing else in the library imports this package; ``__spark_entry__.py`` adds
its queries if it is there.
"""
