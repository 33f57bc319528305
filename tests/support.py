"""What the test modules share (no test imports from a ``conftest``: there are several of that name)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def rows_of(df):
    """Order-insensitive, type-tolerant row multiset of a Spark frame."""
    return sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=repr)


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "∅" if v != v else round(v, 9)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    return str(v)
