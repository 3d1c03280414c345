"""Operators for training-data pipelines (deduplication, decontamination,
language identification, URL filtering, packing, sharding, ...).

Each module holds one operator with its own interface; ``queries`` registers
one thin query per operator.  Nothing else in the library imports this
subpackage.
"""
