"""Row counts that size the pieces work is cut into.  None of them chooses a plan: every
program has one plan, and these say how finely it is spread."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Tuning:
    # A join key above this many rows is cut into slices of about this many rows.
    hot_key_rows: int = 1_000_000
    # A self-join key with more rows than this is cut into blocks of about this many rows.
    pair_block_rows: int = 2_000
    # Partners per bitmap of a seed's settled pairs.
    settled_block: int = 1_024
    # Meetings of a search's round that are formed before the pairs they settle are noted.
    meeting_rows: int = 20_000_000
    # Seeds per bitmap of a search.
    seed_block: int = 512
    # Rows per bucket of an edge table, beyond one bucket per shuffle partition.
    bucket_rows: int = 16_000_000


DEFAULT = Tuning()
