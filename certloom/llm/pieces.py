"""Whole texts in pieces of bounded size."""

from __future__ import annotations

import numpy as np

from . import textops as T


def cuts(buf: np.ndarray, table: np.ndarray, limit: int):
    """Ends of pieces of about ``limit`` bytes, each behind a byte of ``table``; a longer stretch without
    one stays whole."""
    lo, n = 0, len(buf)
    while n - lo > limit:
        at = np.flatnonzero(table[buf[lo:lo + limit]])
        if len(at):
            lo += int(at[-1]) + 1
        else:
            end = lo + limit
            while end < n:
                at = np.flatnonzero(table[buf[end:end + limit]])
                if len(at):
                    end += int(at[0]) + 1
                    break
                end += limit
            lo = min(end, n)
        if lo < n:
            yield lo
    yield n


def text_pieces(column, table: np.ndarray, limit: int = T.SLICE_BYTES):
    """(first row, last, byte buffer, offsets): the slices of a column.  A text longer than ``limit`` comes
    alone and in several pieces, the last one marked, each cut behind a byte of ``table``."""
    for a, buf, off in T.text_slices(column, limit):
        if len(off) > 2 or len(buf) <= limit:
            yield a, True, buf, off
            continue
        lo = 0
        for hi in cuts(buf, table, limit):
            yield a, hi == len(buf), buf[lo:hi], np.array([0, hi - lo])
            lo = hi
