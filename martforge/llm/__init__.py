"""Operators for preparing training corpora: deduplication, decontamination,
search, token files, filtering, fixity, redaction, counting and packing.

Nothing else in the library imports this subpackage. Each operator is one
module; :mod:`martforge.llm.queries` registers one query per operator.
"""
