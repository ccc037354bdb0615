"""Training-data operators on text, page and embedding tables.

Each module is one operator with a general DataFrame interface; ``queries``
applies them to the shared tables and derives the contract columns. Nothing
outside this package imports it.
"""
