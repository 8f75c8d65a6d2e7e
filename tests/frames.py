"""Rows of a frame in an order that does not depend on the plan."""


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
