"""What the queries and their oracles agree on."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import numpy as np

from hourcast.config import METRIC_IDS, ForecastConfig
from hourcast.functions.network import shapes

OPCODES = {"click": "countSAI", "view": "countUL", "purchase": "countUGL", "signup": "countCL"}
# Orders as events: their status is the opcode. Urgent orders above this price choose months.
STATUS_METRICS = {"F": "countUL", "O": "countCL"}
DEAR = 480_000
GRID = ("2024-01-01 00:00:00", "2024-01-31 00:00:00")
AS_OF = date(2024, 2, 15)
ORDERS_AS_OF = date(2000, 3, 15)
LAGS, HORIZON = 168, 24
WINDOWS = ForecastConfig(lags=LAGS, horizon=HORIZON)
TRAIN = ("2024-01-01 00:00:00", "2024-01-10 23:00:00")
VALID = ("2024-01-20 00:00:00", "2024-01-22 23:00:00")
SPOT = "2024-01-15 12:00:00"
SMALL_NET = ForecastConfig(
    account_dim=3,
    metric_dim=2,
    weekday_dim=2,
    relu_width=4,
    lags=24,
    horizon=6,
    learning_rate=1e-2,
    batches=2,
    sub_steps=3,
    check_every=2,
)
SMALL_TRAIN = ("2024-01-01 00:00:00", "2024-01-20 23:00:00")
SMALL_VALID = ("2024-01-24 00:00:00", "2024-01-29 18:00:00")
TINY_NET = ForecastConfig(
    account_dim=2,
    metric_dim=1,
    weekday_dim=1,
    relu_width=2,
    lags=3,
    horizon=2,
    precision="float64",
)
# Shift of the weight rule for account vectors.
ACCOUNT_SHIFT = 10
SQL_FILE = Path(__file__).resolve().parents[1] / "hourcast" / "plans" / "hourly_metrics.sql"


def weight_rule(rows: int, columns: int, shift: int) -> np.ndarray:
    """Given weights: ((7 row + 3 column + shift) mod 17 - 8) / 40."""
    row, column = np.indices((rows, columns))
    return ((7 * row + 3 * column + shift) % 17 - 8) / 40


def given_weights(config: ForecastConfig) -> dict[str, np.ndarray]:
    """Every matrix by the rule; a bias is one column."""
    return {
        name: weight_rule(shape[0], shape[1] if len(shape) > 1 else 1, shift).reshape(shape)
        for shift, (name, shape) in enumerate(shapes(config, len(METRIC_IDS)).items())
    }
