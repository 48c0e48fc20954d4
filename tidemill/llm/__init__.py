"""Training-data operators: dedup, mixing, packing, language ID, secrets, pages, chats.

Nothing outside this subpackage imports it. ``queries`` registers one query per operator.
"""
