"""Operators for large-scale training-data pipelines.

Each module holds one operator with its own general interface; the thin
``opN_<name>`` queries over the test tables and their SQL live in
:mod:`loomwright.llm.queries`.  Nothing else in the library imports this
subpackage.
"""
