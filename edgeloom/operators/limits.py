"""A rate limiter that counts the requests it let in, not those it refused."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.exprs import TS


def admitted(logs: DataFrame, by: str = "cli_ip", limit: int | Column = 100, window_seconds: int = 60, ts: str = TS) -> DataFrame:
    """Requests, and how many of them were let in and refused, per client and second.

    A request is let in while fewer than ``limit`` were let in during the ``window_seconds`` before it; refused ones do not
    count. ``limit`` may be a column of the client, for clients with more room. A request's fate hangs on
    those before it, so each client is folded in order, over its counts per second: the log shrinks to these before it is
    shuffled, and a client has 86,400 of them a day at most, however many requests it makes. The fold keeps the
    seconds of one window. Requests without a time are left out; those without a client are one client.
    """
    second = F.unix_seconds(F.col(ts).cast("timestamp")).alias("s")
    room = limit if isinstance(limit, Column) else F.lit(limit)
    counts = logs.where(F.col(ts).isNotNull()).groupBy(F.col(by), second, room.cast("long").alias("room")).agg(F.count(F.lit(1)).alias("requests"))
    ordered = counts.repartition(by).sortWithinPartitions(by, "s")
    kind = dict(logs.dtypes)[by]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, begun, kept, inside = None, False, deque(), 0
        for batch in batches:
            passed = []
            for c, s, most, n in zip(batch[by], batch["s"].tolist(), batch["room"].tolist(), batch["requests"].tolist()):
                c = None if pd.isna(c) else c
                if not begun or c != client:
                    client, begun, kept, inside = c, True, deque(), 0
                while kept and kept[0][0] <= s - window_seconds:
                    inside -= kept.popleft()[1]
                let_in = max(0, min(n, most - inside))
                if let_in:
                    kept.append((s, let_in))
                    inside += let_in
                passed.append(let_in)
            yield batch[[by, "s", "requests"]].assign(admitted=passed)

    out = ordered.mapInPandas(fold, f"`{by}` {kind}, s long, requests long, admitted long")
    return out.select(by, F.timestamp_seconds("s").alias("second"), "requests", "admitted", (F.col("requests") - F.col("admitted")).alias("refused"))
