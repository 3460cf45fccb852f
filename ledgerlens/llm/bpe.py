"""Operator 3: byte-level BPE encoding and decoding by a two-tier lookup.

Tier one: a minimal perfect hash (hash and displace) over the vocabulary resolves a whole
pre-token that is itself a vocabulary entry with one probe and one comparison. Tier two: any
other pre-token is merged by a heap of candidate pairs over linked byte pieces, O(n log n)
also for a pre-token of a whole text's length. Results are remembered in a bounded memo per
worker, since most pre-tokens of a corpus recur.

Defined results: null and empty text give no tokens; a null doc_id is carried through; every
input row gives one output row; other columns are ignored."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .common import per_document

#: Largest vocabulary (bytes of all entries) that is broadcast; a tokenizer above it is refused.
VOCABULARY_BYTES = 64 << 20
#: Entries of each of a worker's three memos.
MEMO = 1 << 18
_M32 = (1 << 32) - 1


class PerfectHash:
    """Minimal perfect hash: n keys onto slots 0..n-1, one displacement for each small bucket."""

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.buckets = max(1, n // 2)
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, h in enumerate(hashes):
            groups[h % self.buckets].append(i)
        self.shift = [0] * self.buckets
        slot_of, free = [-1] * n, [True] * n
        for b in sorted(range(self.buckets), key=lambda x: -len(groups[x])):
            members = groups[b]
            if len(members) < 2:
                break
            d = 0
            while True:
                slots = {self._slot(hashes[i], d) for i in members}
                if len(slots) == len(members) and all(free[s] for s in slots):
                    break
                d += 1
            self.shift[b] = d
            for i in members:
                slot_of[i] = s = self._slot(hashes[i], d)
                free[s] = False
        rest = iter([s for s in range(n) if free[s]])
        for b, members in enumerate(groups):  # a lone key takes any free slot, written as -slot - 1
            if len(members) == 1:
                slot_of[members[0]] = s = next(rest)
                self.shift[b] = -s - 1
        self.key_at: list[bytes] = [b""] * n
        self.index_at = [0] * n
        for i, s in enumerate(slot_of):
            self.key_at[s], self.index_at[s] = keys[i], i

    def _slot(self, h: int, d: int) -> int:
        return (((h >> 32) + d * ((h & _M32) | 1)) & _M32) * self.n >> 32

    def find(self, key: bytes) -> int:
        """Index of ``key`` among the keys, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        s = -d - 1 if d < 0 else self._slot(h, d)
        return self.index_at[s] if self.key_at[s] == key else -1


def pair_ids(ranks: dict[bytes, int]) -> list[dict[int, int]]:
    """For each left id: right id -> id of their concatenation, for all cuts of all tokens."""
    out: list[dict[int, int]] = [{} for _ in range(max(ranks.values()) + 1)]
    for token, r in ranks.items():
        for k in range(1, len(token)):
            left, right = ranks.get(token[:k]), ranks.get(token[k:])
            if left is not None and right is not None:
                out[left][right] = r
    return out


def byte_pairs(ranks: dict[bytes, int]) -> list[int]:
    """Id of each token of two bytes at 256 * first + second, -1 for no token."""
    return [ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]


def merge(piece: bytes, bytes_ids: list[int], starts: list[int], pairs: list[dict[int, int]]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank merges first, the leftmost at a
    tie. ``after`` and ``before`` link the live pieces by their start, ``held`` has their ids and
    ``rank`` the rank of the pair that begins with a piece, which is the id it merges to; a heap
    entry (rank, start) is stale when the pair that begins there has another rank by now."""
    n, pop, push = len(piece), heapq.heappop, heapq.heappush
    held = [bytes_ids[b] for b in piece]
    rank = [starts[x << 8 | y] for x, y in zip(piece, piece[1:])]
    rank.append(-1)
    wide = n.bit_length()
    low = (1 << wide) - 1
    heap = [r << wide | i for i, r in enumerate(rank) if r >= 0]
    heapq.heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # start of the next / previous piece
    while heap:
        entry = pop(heap)
        i, r = entry & low, entry >> wide
        if rank[i] != r:
            continue
        j = after[i]
        end = after[i] = after[j]
        held[i], rank[i], rank[j] = r, -1, -1
        if end < n:
            before[end] = i
            right, follow = held[end], pairs[r]
            if right in follow:
                rank[i] = x = follow[right]
                push(heap, x << wide | i)
        p = before[i]
        if p >= 0:
            follow = pairs[held[p]]
            if r in follow:
                rank[p] = x = follow[r]
                push(heap, x << wide | p)
            else:
                rank[p] = -1
    ids, i = [], 0
    while i < n:
        ids.append(held[i])
        i = after[i]
    return ids


class Memo(dict):
    """key -> its ids as decimal text joined by spaces; holds the last ``MEMO`` short keys, and as
    many before them, of which those asked for again come back."""

    def __init__(self, make: Callable[[str], str]):
        super().__init__()
        self.make = make
        self.older: dict[str, str] = {}

    def __missing__(self, key: str) -> str:
        ids = self.older.get(key)
        if ids is None:
            ids = self.make(key)
        if len(self) >= MEMO:
            self.older = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = ids
        return ids


class Encoder:
    """Encodes and decodes with one vocabulary.

    A text whose white space is single spaces and newlines between words is cut there first:
    such a space belongs to the pre-token behind it and such a newline is one of its own,
    under the pattern family ``... ?\\p{L}+ ... |\\s+(?!\\S)|\\s+``, so a word's pre-tokens do
    not depend on its neighbours and can be remembered whole. Any other text is matched by
    the pattern from end to end."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, table: PerfectHash):
        self.ranks, self.table = ranks, table
        self.ids = list(ranks.values())
        self.bytes_ids, self.starts, self.pairs = [ranks[bytes([b])] for b in range(256)], byte_pairs(ranks), pair_ids(ranks)
        self.split = regex.compile(pattern).findall
        self.piece = {str(i): t for t, i in ranks.items()}
        self.tokens = Memo(self._token)
        self.bare = Memo(self._chunk)
        self.spaced = Memo(lambda word: self._chunk(" " + word))
        self.by_word = self.split("a\nb c") == ["a", "\n", "b", " c"]

    def _token(self, token: str) -> str:
        raw = token.encode()
        k = self.table.find(raw)
        return str(self.ids[k]) if k >= 0 else " ".join(map(str, merge(raw, self.bytes_ids, self.starts, self.pairs)))

    def _chunk(self, text: str) -> str:
        tokens = self.split(text)
        # one pre-token alone is remembered by the caller's memo
        return self._token(tokens[0]) if len(tokens) == 1 else " ".join(map(self.tokens.__getitem__, tokens))

    def encode(self, raw: bytes | None) -> str:
        """Decimal ids joined by one space."""
        if not raw:
            return ""
        text = raw.decode()
        parts: list[str] = []
        if not self.by_word:
            return self._chunk(text)
        for line in text.split("\n"):
            words = line.split(" ")
            if not line or words != line.split():
                return self._chunk(text)
            if parts:
                parts.append(self.bare["\n"])
            parts.append(self.bare[words[0]])
            parts.extend(map(self.spaced.__getitem__, words[1:]))
        return " ".join(parts)

    def decode(self, ids: list[str]) -> bytes:
        return b"".join(map(self.piece.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file (base64 token, rank per line), with its size checked."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if sum(map(len, ranks)) > VOCABULARY_BYTES:
        raise ValueError(f"{path}: vocabulary above {VOCABULARY_BYTES} bytes is not broadcast")
    return ranks


_encoders: dict = {}


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, keep: bool = False,
                     with_ids: bool = False) -> DataFrame:
    """Encode and decode whole texts: n_tokens, ids_sha256 (of the decimal ids joined by one
    space), decoded_sha256 (of the bytes the ids decode to); ``with_ids`` adds token_ids."""
    ranks = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, PerfectHash(list(ranks))))

    def make():
        ranks, table = shared.value
        if _encoders.get("made for") != (ranks_path, len(ranks), pattern):  # kept while a worker is reused
            _encoders.update({"made for": (ranks_path, len(ranks), pattern), "encoder": Encoder(ranks, pattern, table)})
        encoder = _encoders["encoder"]

        def score(texts):
            counts, sums, backs, all_ids = [], [], [], []
            for text in texts:
                joined = encoder.encode(text)
                ids = joined.split()
                counts.append(len(ids))
                sums.append(hashlib.sha256(joined.encode()).hexdigest())
                backs.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                if with_ids:
                    all_ids.append(np.array(ids, dtype=np.int32) if ids else np.zeros(0, np.int32))
            return [pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(backs, pa.string())] + (
                [pa.array(all_ids, pa.list_(pa.int32()))] if with_ids else [])

        return score

    return per_document(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string"
                        + (", token_ids array<int>" if with_ids else ""), make, keep)
