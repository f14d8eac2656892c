"""Helpers that test modules import by a name of their own."""


def tuples(df):
    return [tuple(r) for r in df.collect()]
