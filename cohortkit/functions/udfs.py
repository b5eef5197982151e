"""The Python UDF surface (J1), as an Arrow-batched Pandas UDF.

The built-in :func:`cohortkit.functions.columns.dense_cosine` is the fast
path; this variant exists for callers that want a Python function.  It
returns ``double`` (not an untyped string) and NULL for a zero norm
instead of failing the job.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


@F.pandas_udf("double")
def cosine_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    out = np.full(len(a), np.nan)
    valid = np.array([x is not None and y is not None and len(x) == len(y) and len(x) > 0
                      for x, y in zip(a, b)], dtype=bool)
    if valid.any():
        xa = np.stack([np.asarray(x, dtype=np.float64) for x in a[valid]])
        xb = np.stack([np.asarray(y, dtype=np.float64) for y in b[valid]]) \
            if len({len(y) for y in b[valid]}) == 1 else None
        if xb is not None and xa.shape == xb.shape:
            dot = np.einsum("ij,ij->i", xa, xb)
            den = np.linalg.norm(xa, axis=1) * np.linalg.norm(xb, axis=1)
        else:
            pairs = [(np.asarray(x, float), np.asarray(y, float)) for x, y in zip(a[valid], b[valid])]
            dot = np.array([x @ y for x, y in pairs])
            den = np.array([np.linalg.norm(x) * np.linalg.norm(y) for x, y in pairs])
        with np.errstate(divide="ignore", invalid="ignore"):
            out[valid] = np.where(den > 0, dot / den, np.nan)
    return pd.Series(out).where(~np.isnan(out), None)
