"""Groups that follow each other in a sorted partition, for folds of which most are small: many are one call of Python."""

from __future__ import annotations

import numpy as np
import pandas as pd


def begins(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """The rows at which a group begins, in rows in the order of their keys."""
    other = np.zeros(len(rows), dtype=bool)
    other[:1] = True
    for k in keys:
        values, missing = rows[k].to_numpy(), rows[k].isna().to_numpy()
        other[1:] |= ((values[1:] != values[:-1]) & ~(missing[1:] & missing[:-1])).astype(bool)
    return np.flatnonzero(other)


def whole_groups(batches, keys: list[str]):
    """The rows of sorted batches again, cut where a group ends; held is a batch and the group that it breaks off."""
    held: list[pd.DataFrame] = []
    for rows in batches:
        if not len(rows):
            continue
        begin = begins(pd.concat([held[-1].iloc[-1:], rows], ignore_index=True) if held else rows, keys)
        last = int(begin[-1]) - bool(held)
        if len(begin) == 1:  # the same group goes on
            held.append(rows)
            continue
        yield pd.concat([*held, rows.iloc[:last]], ignore_index=True)
        held = [rows.iloc[last:]]
    if held:
        yield pd.concat(held, ignore_index=True)
