"""Operators for preparing text corpora for language-model training.

Nothing else in the package imports this one. Each module holds one operator with a general
interface; :mod:`lociweave.llm.queries` applies them to whole tables as registered queries.

Conventions shared by all operators: input columns are picked by name and everything else in
the table is ignored, so extra columns (also ones called like an output) do no harm; a null
text counts as empty; rows are never dropped unless dropping is what the operator does.
"""
