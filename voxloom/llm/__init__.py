"""Operations for large training-data pipelines: one module per operator.

Every operator is a ``DataFrame -> DataFrame`` function with its own general
interface; the ``opN_*`` query beside it derives the digest columns from the
operator's real output.  ``registry`` lists the queries and their SQL.
"""
