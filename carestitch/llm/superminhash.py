"""Signatures of sets by SuperMinHash (public: O. Ertl, 2017), for many sets at once.

Each element walks a random permutation of the signature's places; its j-th step offers the place it meets
the rank j plus a random fraction. A place keeps the smallest rank. All elements take their j-th step together:
once a set has no empty place after step j, no later step can change it, so its walk stops there. Ranks of one
element are spread over all places instead of drawn independently, which is what lowers the variance.
"""

from __future__ import annotations

import numpy as np

from .words import mix

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def signatures(owner: np.ndarray, element: np.ndarray, sets: int, places: int, slice_: int = 1 << 16) -> np.ndarray:
    """Ranks by set and place (step in the upper, fraction in the lower 32 bits); sets without elements stay empty.

    ``owner`` ascends. At most ``slice_`` elements walk at a time, whatever the size of a set: ranks are minima, so
    slices merge in place, and a set is closed once every rank it holds is of an earlier step.
    """
    ranks = np.full((sets, places), _EMPTY, np.uint64)
    for start in range(0, len(owner), slice_):
        part = owner[start:start + slice_]
        low = int(part[0])
        _walk(part - low, element[start:start + slice_], ranks[low:int(part[-1]) + 1])
    return ranks


def _walk(owner: np.ndarray, element: np.ndarray, ranks: np.ndarray) -> None:
    """Lowers ``ranks`` (a row for each owner) by the walks of some elements."""
    places = ranks.shape[1]
    flat = ranks.reshape(-1)
    order = np.broadcast_to(np.arange(places, dtype=np.uint8 if places <= 256 else np.uint16), (len(owner), places)).copy()
    half = np.uint64(32)
    for step in range(places):
        if not len(owner):
            break
        drawn = mix(element ^ mix(np.full(1, step + 1, np.uint64)))
        other = step + (((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(places - step)) >> half).astype(np.int64)
        row = np.arange(len(owner))
        place = order[row, other]
        order[row, other] = order[:, step]
        np.minimum.at(flat, owner * places + place, (np.uint64(step) << half) | (drawn >> half))
        stay = (ranks >= np.uint64(step + 1) << half).any(axis=1)[owner]
        if not stay.all():
            owner, element, order = owner[stay], element[stay], order[stay]


def band_keys(ranks: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    sets, places = ranks.shape
    rows = places // bands
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (sets, bands)).copy()
    for i in range(rows):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) ^ ranks[:, i:bands * rows:rows])
    return keys
