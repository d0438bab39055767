"""Result rows by their id."""


def by_id(df, name="doc_id"):
    return {row[name]: row for row in df.collect()}
