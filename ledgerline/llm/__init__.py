"""Training-data operators: quality, mixing, de-duplication, archives,
tokens, chat formatting, extraction and decontamination.

Nothing outside this subpackage imports it. Each module holds one operator
with a general interface; ``queries`` registers the thin contract queries.
"""
