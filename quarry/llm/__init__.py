"""Operations of a large-scale training-data pipeline.

Nothing else in Quarry imports this subpackage. One module per operator, the
registered queries in ``queries`` and their SQL in ``oracles``.
"""
