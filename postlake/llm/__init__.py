"""Operators for preparing a text corpus for language-model training.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``queries`` has the thin queries that
apply them to the test tables.

Conventions shared by all operators:

* A row is a document.  ``doc_id`` only names it: repeated rows and repeated
  ids are allowed, and NULL is an id like any other unless a docstring says
  otherwise.  Where rows must be found again after a shuffle they are keyed by
  (id, hash of the text).
* A NULL text counts as the empty text.  Empty tables give empty results.
* Input columns an operator does not use are ignored, or carried along where
  it says so; they never clash with its own columns, because intermediate
  frames select what they need under fresh names.
* Whole texts are processed, whatever their length.
"""
