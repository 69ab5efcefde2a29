"""Operators for preparing large text corpora: one module per operator, the
registered queries in ``queries``. Nothing outside this package imports it."""
