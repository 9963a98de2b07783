"""Errors of single forecast cells."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from hourcast.config import SMAPE_FLOOR


def smape_cell(y: Column, yhat: Column) -> Column:
    """|y - yhat| / max(|y| + |yhat|, floor) of one cell."""
    y, yhat = y.cast("double"), yhat.cast("double")
    return F.abs(y - yhat) / F.greatest(F.abs(y) + F.abs(yhat), F.lit(SMAPE_FLOOR))


def smape_cells(y: np.ndarray, yhat: np.ndarray) -> np.ndarray:
    """`smape_cell` of every cell of two double arrays."""
    return np.abs(y - yhat) / np.maximum(np.abs(y) + np.abs(yhat), SMAPE_FLOOR)


def log_square_cell(y: Column, yhat: Column) -> Column:
    """(ln y - ln yhat)^2 of one cell."""
    gap = F.ln(y.cast("double")) - F.ln(yhat.cast("double"))
    return gap * gap
