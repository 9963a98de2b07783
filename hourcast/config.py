"""Labels, constants and hyper-parameters."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values ---------------------------------------------------------------
# Signalling opcodes that are metrics of their own; every other opcode is only
# counted in the total.
OPCODE_METRICS = {
    "sendAuthenticationInfo": "countSAI",
    "updateLocation": "countUL",
    "updateGprsLocation": "countUGL",
    "cancelLocation": "countCL",
}
TOTAL_METRIC = "mapsum"

# Session records counted when they carry the success code.
RECORD_TYPE_METRICS = {"createPdpCountV1": 1, "deletePdpCountV1": 2}
SUCCESS_CODE = 128
SUBSCRIBER_METRIC = "imsiSum"

# Metric ids of the multi-account and of the single-account series.
METRIC_IDS = {
    "countUL": 0,
    "imsiSum": 1,
    "countCL": 2,
    "deletePdpCountV1": 3,
    "createPdpCountV1": 4,
    "mapsum": 5,
    "countSAI": 6,
    "countUGL": 7,
}
SINGLE_ACCOUNT_METRIC_IDS = {
    "countCL": 0,
    "countSAI": 1,
    "countUGL": 2,
    "countUL": 3,
    "gtpv1sum": 4,
    "gtpv2sum": 5,
    "imsisum": 6,
    "mapsum": 7,
    "usagesum": 8,
}

# Stands in for zeros and gaps so that the logarithm is finite: the float32
# machine epsilon.
EPS = 2.0**-23

# Floor of the sMAPE denominator.
SMAPE_FLOOR = 1e-8
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class ForecastConfig:
    """Shape and training schedule of the forecaster.

    An embedding size of 0 leaves that key out of the model. `precision` is that
    of the network on a chunk of windows; weights and sums are always double.
    `batch_size` windows of the random order make a batch, and the first `batches` of them
    are trained on; without it all windows are dealt into `batches`. A job makes
    `local_steps` updates.
    """

    account_dim: int = 7
    metric_dim: int = 4
    weekday_dim: int = 4
    relu_width: int = 12
    lags: int = 672
    horizon: int = 168
    learning_rate: float = 1e-4
    batches: int = 5
    batch_size: int | None = None
    sub_steps: int = 2_000
    local_steps: int = 1
    stop_below: float | None = 10.5
    check_every: int = 100
    precision: str = "float32"

    @property
    def width(self) -> int:
        return self.lags + self.horizon

    @property
    def hidden(self) -> int:
        """Width of the sigmoid layer: the log-lags next to the last relu layer."""
        return self.lags + self.relu_width


MULTI_ACCOUNT = ForecastConfig(batch_size=26_880)
SINGLE_ACCOUNT = ForecastConfig(
    account_dim=0,
    metric_dim=16,
    weekday_dim=16,
    relu_width=8,
    batches=10,
    batch_size=1_000,
    sub_steps=20_000,
    stop_below=None,
    check_every=20_000,
)
