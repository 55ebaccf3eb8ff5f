"""Sums of dense vectors by a tree of small additions, and a minimal perfect hash of integer keys."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 16
# Bits of a level for each key that is left; more bits leave fewer keys to the next level.
BITS_PER_KEY = 1.6
MOST_LEVELS = 64


def adder(dtype: str) -> Callable[[pa.Table], pa.Table]:
    def add(rows: pa.Table) -> pa.Table:
        total = None
        for value in rows["values"]:
            vector = np.frombuffer(value.as_buffer(), dtype)
            total = vector.copy() if total is None else total + vector
        return pa.table({"segment": rows["segment"][:1], "part": rows["part"][:1], "values": pa.array([total.tobytes()], pa.binary())})

    return add


def tree_sum(parts: DataFrame, dtype: str, fan: int = FAN) -> DataFrame:
    """(segment, values): the sums of the vectors ``values`` (binary) of each segment, ``fan`` at a time.

    ``parts`` is stored and numbers its rows of a segment by ``part``, from 0. No task holds more than ``fan`` vectors,
    however many there are. No rows give no rows.
    """
    most = parts.agg(F.max("part")).first()[0] or 0
    while True:
        most //= fan
        above = parts.select("segment", F.floor(F.col("part") / fan).alias("part"), "values")
        parts = above.groupBy("segment", "part").applyInArrow(adder(dtype), "segment int, part long, values binary")
        if not most:
            return parts.select("segment", "values")


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Well spread 64-bit numbers of 64-bit keys: products and shifts, one-to-one for each seed."""
    with np.errstate(over="ignore"):
        x = keys ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def perfect_levels(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimal perfect hash of different ``keys`` (uint64): (words of each level, bits of all levels, keys in slot order).

    On each level a key takes a bit. Keys that are alone on theirs keep it, the others go to the next level. The slot of a
    key is the number of bits set before its own.
    """
    sizes, words, slots, left = [], [], [], keys
    while len(left):
        if len(sizes) == MOST_LEVELS:
            raise ValueError("keys are repeated")
        n = -(-int(len(left) * BITS_PER_KEY) // 64) or 1
        at = (mixed(left, len(sizes) + 1) % np.uint64(64 * n)).astype(np.int64)
        alone = np.bincount(at, minlength=64 * n) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        keeps = alone[at]
        slots.append(left[keeps][np.argsort(at[keeps])])
        sizes.append(n)
        left = left[~keeps]
    empty = np.zeros(0, np.uint64)
    return np.array(sizes, np.int64), np.concatenate([empty, *words]), np.concatenate([empty, *slots])


class PerfectHash:
    """The slots of keys of several shards, one after the other; a key that none of them has gets -1."""

    def __init__(self, sizes: list[np.ndarray], words: list[np.ndarray], keys: list[np.ndarray]):
        depth = max(map(len, sizes), default=0)
        self.size = np.zeros((len(sizes), depth), np.int64)
        for i, s in enumerate(sizes):
            self.size[i, : len(s)] = s
        before = np.cumsum(self.size.ravel()) - self.size.ravel()
        self.begin = before.reshape(self.size.shape)
        self.words = np.concatenate([np.zeros(0, np.uint64), *words])
        self.rank = np.cumsum(np.bitwise_count(self.words), dtype=np.int64) - np.bitwise_count(self.words)
        self.keys = np.concatenate([np.zeros(0, np.uint64), *keys])

    def slots(self, keys: np.ndarray, shards: np.ndarray) -> np.ndarray:
        """``shards`` are places in the lists that this was made of. Every slot's key is compared with the key asked for."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level in range(self.size.shape[1]):
            shard, key = shards[left], keys[left]
            size = self.size[shard, level]
            there = size > 0
            left, shard, key, size = left[there], shard[there], key[there], size[there]
            if not len(left):
                break
            at = mixed(key, level + 1) % (64 * size).astype(np.uint64)
            place = self.begin[shard, level] + (at >> np.uint64(6)).astype(np.int64)
            bit = at & np.uint64(63)
            word = self.words[place]
            hit = (word >> bit) & np.uint64(1) == 1
            below = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.rank[place[hit]] + np.bitwise_count(below)
            left = left[~hit]
        known = np.flatnonzero(out >= 0)
        out[known[self.keys[out[known]] != keys[known]]] = -1
        return out
