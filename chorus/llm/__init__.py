"""Training-data operators: language ID, sharding, deduplication, chat
formatting, tokenisation, mixing and nearest-neighbour search.

Nothing outside this subpackage imports it.  Each module holds one operator;
:mod:`chorus.llm.queries` registers them over the test tables.
"""
