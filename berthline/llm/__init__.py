"""Operators of a training-data pipeline: filtering, personal data, fingerprints, packing,
near-duplicate joins, licence scans, language identification and tokenization.

Nothing outside this subpackage imports it, except the guarded registration in
``__spark_entry__.py`` and the pipeline at the repository top.
"""
