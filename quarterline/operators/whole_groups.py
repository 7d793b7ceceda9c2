"""Arrow batches cut at group boundaries rather than anywhere."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd


def whole_groups(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """The rows of the batches, clustered by key as they come, in frames that hold whole groups only.

    Holds back the last group of each batch, so groups must be small: callers reduce them beforehand.
    """
    held: pd.DataFrame | None = None
    for batch in batches:
        if not len(batch):
            continue
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = pd.Series(True, held.index)
        for k in keys:
            last &= held[k] == held[k].iat[-1]
        if not last.all():
            yield held[~last].reset_index(drop=True)
            held = held[last].reset_index(drop=True)
    if held is not None:
        yield held


def group_numbers(frame: pd.DataFrame, keys: Sequence[str]):
    """0, 1, 2 ... per group of clustered rows."""
    new = pd.Series(False, frame.index)
    for k in keys:
        new |= frame[k] != frame[k].shift()
    return new.to_numpy().cumsum() - 1
