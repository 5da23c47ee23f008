"""Deterministic endpoints for workloads and tests: senders whose answers follow
from the record key, so delivery results can be stated in SQL."""

from __future__ import annotations

import numpy as np
import pandas as pd

# Per record key, 500 for multiples of 50 (those ending in 50
# succeed on the second attempt), else 429 for multiples of 31 (Retry-After =
# key mod 3 seconds), else a transport error 999 for multiples of 97, else 202.
REASONS = {202: "Accepted", 500: "Internal Server Error", 429: "Too Many Requests",
           999: "Protocol error"}


def rule_sender(requests: pd.DataFrame, attempt: int) -> pd.DataFrame:
    k = requests["key"].astype("int64").to_numpy()
    status = np.select(
        [(k % 100 == 50) & (attempt >= 2), k % 50 == 0, k % 31 == 0, k % 97 == 0],
        [202, 500, 429, 999], 202)
    retry_after = np.where(status == 429, k % 3, 0)
    return pd.DataFrame({"status": status, "reason": [REASONS[s] for s in status],
                         "retry_after": retry_after})


def bulk_rule_sender(requests: pd.DataFrame, attempt: int) -> pd.DataFrame:
    """Deterministic bulk endpoint. An envelope ``bucket-n``
    fails with 500 when (bucket + n) is a multiple of 5, else 202."""
    be = requests["key"].str.split("-", expand=True).astype("int64")
    status = np.where((be[0] + be[1]) % 5 == 0, 500, 202)
    return pd.DataFrame({"status": status, "reason": [REASONS[s] for s in status],
                         "retry_after": np.zeros(len(status), dtype="int64")})
