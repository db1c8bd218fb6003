"""Operators for preparing training text. Nothing else in the library imports this package.

Common conventions, which every operator keeps unless its docstring says otherwise:

- A null text is an empty text, and every whole text is read.
- ``doc_id`` names a document. Repeated rows of one id are kept as rows of the
  result; where a rule counts documents, they count once. A null id is one more
  id, smaller than all others.
- Further input columns are passed over or passed through; a column that has the
  name of an output column is replaced by it.
- Empty tables give empty results with the same columns.
"""
