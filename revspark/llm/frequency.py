"""How often 64-bit keys occur in the corpus, as a table of fixed size.

Tasks add up what they hold and send each key as a 32-bit remainder, packed
per hash range, with the counts of those that repeat; each range is counted
exactly by one group.  What comes back is
a table of ``slots`` small numbers (the highest level of any key of a slot),
so its size never depends on the corpus.  A slot shared by a rare and a
frequent key reports the higher level: readers treat a level as an ordering
or prefilter hint that is the same for every document, never as a count.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .scratch import freed_shuffles
from .workers import give_back

PACK_SCHEMA = "part int, packed binary, at binary, more binary"
FLUSH = 1_000_000     # keys a task holds before it sends them


def part_bits(text_bytes: int) -> int:
    """Hash ranges so that one holds the keys of about 16 MB of text."""
    return min(22, max(6, math.ceil(math.log2(max(1, text_bytes) / 2**24)) if text_bytes > 2**24 else 6))


class KeyPacker:
    def __init__(self, bits: int):
        self.bits, self.held, self.n = bits, [], 0

    def add(self, keys: np.ndarray):
        self.held.append(keys)
        self.n += len(keys)

    def full(self) -> bool:
        return self.n >= FLUSH

    def flush(self):
        """One record batch: a row per hash range."""
        if not self.n:
            return
        keys = np.concatenate(self.held)
        self.held, self.n = [], 0
        keys, n = np.unique(keys, return_counts=True)
        part = (keys >> np.uint64(64 - self.bits)).astype(np.int32)
        rest = ((keys >> np.uint64(32 - self.bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        packed, at, more = [], [], []
        for s, e in zip(cut, np.r_[cut[1:], len(part)]):
            often = np.flatnonzero(n[s:e] > 1)
            packed.append(rest[s:e].tobytes())
            at.append(often.astype(np.uint32).tobytes())
            more.append((n[s:e][often] - 1).astype(np.uint32).tobytes())
        yield pa.record_batch([pa.array(part[cut], pa.int32()), *(pa.array(x, pa.binary()) for x in (packed, at, more))],
                              ["part", "packed", "at", "more"])


def levels(packed: DataFrame, bits: int, bounds: list[int], slot_bits: int) -> np.ndarray:
    """``uint8[2**slot_bits]``: for a key, the number of ``bounds`` that its
    count exceeds.  With a single bound the table is packed to single bits."""
    per = slot_bits - bits
    one = len(bounds) == 1

    def slots(table) -> bytes:
        # key and count in one number: the sorted numbers are all that is held of the group
        runs = np.empty(sum(len(x.as_py()) for x in table["packed"]) // 4, np.uint64)
        end = 0
        for x, at, more in zip(table["packed"], table["at"], table["more"]):
            keys = np.frombuffer(x.as_py(), np.uint32)
            own = runs[end:end + len(keys)]
            own[:] = keys
            own <<= np.uint64(32)
            own += np.uint64(1)
            own[np.frombuffer(at.as_py(), np.uint32)] += np.frombuffer(more.as_py(), np.uint32)
            end += len(keys)
        runs.sort()
        keys = (runs >> np.uint64(32)).astype(np.uint32)
        runs &= np.uint64(2**32 - 1)
        start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        level = np.searchsorted(bounds, np.add.reduceat(runs, start).view(np.int64), "left").astype(np.uint8)
        out = np.zeros(1 << per, np.uint8)
        hot = level > 0
        np.maximum.at(out, keys[start[hot]] >> np.uint32(32 - per), level[hot])
        if one:
            out = np.packbits(out, bitorder="little")
        return out.tobytes()

    def count(key, table):
        out = slots(table)
        give_back()
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "levels": pa.array([out], pa.binary())})

    with freed_shuffles(packed.sparkSession):
        rows = packed.groupBy("part").applyInArrow(count, "part int, levels binary").collect()
    size = (1 << slot_bits) // (8 if one else 1)
    table = np.zeros((1 << bits, size >> bits), np.uint8)
    for r in rows:
        table[r["part"]] = np.frombuffer(r["levels"], np.uint8)
    del rows
    give_back()
    return table.reshape(-1)


def lookup(table: np.ndarray, keys: np.ndarray, slot_bits: int) -> np.ndarray:
    """Level of each key; 0/1 for a table of single bits."""
    slot = keys >> np.uint64(64 - slot_bits)
    if len(table) < (1 << slot_bits):
        return (table[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
    return table[slot]
