"""Operators for preparing large text corpora.

Each module holds one operator with its own interface; ``queries`` registers
one thin query per operator. Nothing outside this subpackage imports it.
"""
