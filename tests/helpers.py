import math

import pandas as pd


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "item"):
        return norm(v.item())
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def assert_same(a: pd.DataFrame, b: pd.DataFrame):
    ca, ra = rows(a)
    cb, rb = rows(b)
    assert ca == cb
    assert len(ra) == len(rb)
    bad = [(x, y) for x, y in zip(ra, rb) if x != y]
    assert not bad, bad[:3]
