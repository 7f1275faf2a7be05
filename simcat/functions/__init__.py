from simcat.functions import parsers, text, vectors  # noqa: F401
