"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage.  Every operator works on
whole texts and whole tables; :mod:`tessera.llm.queries` binds the operators to
the driver's tables.

Common conventions
------------------
* A *document* is a row.  Repeated rows (equal ``doc_id`` and ``text``) each get
  their own result row; a null ``doc_id`` is passed through.
* A null text behaves as an empty text unless an operator says otherwise.
* Only the columns an operator names are read, so extra columns with any name
  are harmless.
* Words are ``[^\\x20\\x09-\\x0D]+``.
"""
