"""Operations on corpora for training language models.

One module per operator; ``queries`` applies each of them to its whole table.
Nothing outside this subpackage imports it.
"""
