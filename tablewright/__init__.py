"""Reusable table operators for PySpark.

Import from the modules: ``sources``, ``sinks``, ``operators``, ``models``, ``plans``,
``streaming``.
"""
