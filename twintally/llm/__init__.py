"""Operators for preparing the text a language model is trained on.

Nothing else in the library imports this subpackage. Each module holds one
operator with its general interface; :mod:`twintally.llm.queries` applies them to
the tables with production settings.
"""
