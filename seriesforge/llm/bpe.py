"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece the table holds the one token that ends the prefix's encoding. A token may follow
another exactly when the merges, run on the two tokens' bytes alone, give those two tokens back. Whether they do is
read off the seam: each token has a left and a right edge, the parts that stand at that end while its bytes merge, in the
order of the merges; walking both edges together shows every pair of parts that ever meets at the seam, and the
tokens stay apart when no such pair is itself merged before one of its parts is used up. The last token of a prefix
is then the longest vocabulary entry ending there that may follow the last token of what precedes it, and the encoding is
read off backwards. A table can be appended to, and after an edit entries are computed again only until they rejoin
the old ones.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of the per-process memo of pieces, and of token pairs, before it is emptied.
MEMO = 400_000
#: No match of the pattern looks further than this many characters beyond its end.
LOOK = 3
_NEVER = 1 << 40


def merge_steps(data: bytes, ranks: dict[bytes, int]) -> Iterator[list[bytes]]:
    """The parts of ``data`` before the first and after every rank-ordered merge of adjacent parts."""
    parts = [data[i : i + 1] for i in range(len(data))]
    yield parts
    while len(parts) > 1:
        found = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        if not found:
            break
        at = min(found)[1]
        parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]
        yield parts


def merge_bytes(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Plain rank-ordered merging: the definition, used on single tokens and in tests."""
    parts: list[bytes] = []
    for parts in merge_steps(data, ranks):  # noqa: B007
        pass
    return [ranks[p] for p in parts]


class Vocabulary:
    """Ranks of a byte-level vocabulary, the pattern that cuts a text into pieces, and the memos of encoding."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = [b""] * (1 + max(ranks.values()))
        # every suffix of a token: the token that it is, or -1
        self.ending: dict[bytes, int] = {}
        for t, r in ranks.items():
            self.token[r] = t
            for i in range(1, len(t)):
                self.ending.setdefault(t[i:], -1)
        self.ending.update(ranks)
        self.pattern = regex.compile(pattern)
        self.longest = max(map(len, ranks))
        self.follows: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}
        self.edges: dict[int, tuple[list[int], list[int]] | None] = {}

    @classmethod
    @lru_cache(maxsize=4)
    def load(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def edge(self, t: int) -> tuple[list[int], list[int]] | None:
        """Left and right edge of a token: the parts that begin and end it while its bytes merge, up to itself.

        None for a token whose own bytes do not merge to it; such a token is in no encoding.
        """
        if t not in self.edges:
            left: list[int] = []
            right: list[int] = []
            parts: list[bytes] = []
            for parts in merge_steps(self.token[t], self.ranks):
                first, last = self.ranks[parts[0]], self.ranks[parts[-1]]
                if not left or left[-1] != first:
                    left.append(first)
                if not right or right[-1] != last:
                    right.append(last)
            self.edges[t] = (left, right) if len(parts) == 1 else None
        return self.edges[t]

    def apart(self, before: int, t: int) -> bool:
        """Whether the bytes of the two tokens together merge to exactly these two tokens."""
        one, two = self.edge(before), self.edge(t)
        if one is None or two is None:
            return False
        ranks, token, right, left = self.ranks, self.token, one[1], two[0]
        i = j = 0
        while True:
            after_x = right[i + 1] if i + 1 < len(right) else _NEVER
            after_y = left[j + 1] if j + 1 < len(left) else _NEVER
            seam = ranks.get(token[right[i]] + token[left[j]])
            # of equal ranks the leftmost pair merges first
            if seam is not None and seam < after_x and seam <= after_y:
                return False
            if after_x == after_y == _NEVER:
                return True
            if after_x <= after_y:
                i += 1
            else:
                j += 1

    def may_follow(self, before: int, t: int) -> bool:
        key = before << 24 | t
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) >= MEMO:
                self.follows.clear()
            known = self.follows[key] = self.apart(before, t)
        return known

    def piece(self, text: str) -> bytes:
        """Ids of one piece as packed little-endian unsigned 32-bit integers."""
        packed = self.memo.get(text)
        if packed is None:
            data = text.encode("utf-8", "surrogatepass")
            one = self.ranks.get(data)
            ids = [one] if one is not None else Prefixes(self, data).ids()
            if len(self.memo) >= MEMO:
                self.memo.clear()
            packed = np.array(ids, "<u4").tobytes()
            if len(data) <= 64:
                self.memo[text] = packed
        return packed

    def encode(self, text: str) -> bytes:
        memo, piece = self.memo, self.piece
        return b"".join([memo.get(p) or piece(p) for p in self.pattern.findall(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Prefixes:
    """The last token of every prefix of one piece, kept up to date under appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def _next(self, end: int) -> int:
        """The last token of the first ``end`` bytes, whose own prefixes are known."""
        v, data, last = self.vocabulary, self.data, self.last
        ending, found, start = v.ending, [], end
        while start:
            t = ending.get(data[start - 1 : end])
            if t is None:
                break
            start -= 1
            if t >= 0:
                found.append((start, t))
        for start, t in reversed(found):
            if v.may_follow(last[start - 1], t) if start else v.edge(t) is not None:
                return t
        raise ValueError(f"no token ends the first {end} bytes")

    def append(self, more: bytes) -> None:
        self.data += more
        for end in range(len(self.last) + 1, len(self.data) + 1):
            self.last.append(self._next(end))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Edit bytes start:end. Entries before the edit stay; how many were computed again is returned.

        An entry follows from the ``longest`` bytes and entries before it, so once that many entries behind the edit
        come out as they were, all later ones are as they were.
        """
        old, self.last = self.last, self.last[:start]
        shift = len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        same, at = 0, start
        while at < len(self.data):
            at += 1
            self.last.append(self._next(at))
            same = same + 1 if at > start + len(new) and old[at - shift - 1] == self.last[-1] else 0
            if same >= self.vocabulary.longest:
                self.last += old[at - shift :]
                break
        return at - start

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            t = self.last[end - 1]
            out.append(t)
            end -= len(self.vocabulary.token[t])
        return out[::-1]


class Encoded:
    """A text with the ids of its pieces; appends and edits cut and encode only the pieces around them again.

    Holds for patterns whose matches look at most ``LOOK`` characters beyond their end, and never behind their start.
    """

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary, self.text = vocabulary, text
        self.pieces = vocabulary.pattern.findall(text)
        self.packed = [vocabulary.piece(p) for p in self.pieces]

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> int:
        """Edit characters start:end of the text; returns the number of pieces cut again."""
        v, shift = self.vocabulary, len(new) - (end - start)
        edges = [0, *accumulate(map(len, self.pieces))]
        self.text = self.text[:start] + new + self.text[end:]
        first = max(0, int(np.searchsorted(edges, start, "right")) - 1 - LOOK)
        old = {e + shift: k for k, e in enumerate(edges) if e >= end}
        at, made, rest = edges[first], [], len(self.pieces)
        while at < len(self.text):
            piece = v.pattern.match(self.text, at)[0]
            made.append(piece)
            at += len(piece)
            if at >= start + len(new) and at in old:
                rest = old[at]
                break
        self.pieces[first:rest] = made
        self.packed[first:rest] = map(v.piece, made)
        return len(made)

    def ids(self) -> bytes:
        return b"".join(self.packed)


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, *, text_col: str = "text", digests: bool = False) -> DataFrame:
    """All columns of ``docs`` plus ``n_tokens`` and ``ids`` (packed little-endian unsigned 32-bit) and ``decoded``.

    Each match of ``pattern`` is encoded on its own, without special tokens; ``decoded`` are the bytes that the ids
    stand for. Null and empty texts have no tokens; repeated rows get the same ids. With ``digests`` the two binary columns are replaced by
    ``ids_sha256`` and ``decoded_sha256`` where they are made. Input columns of these names are replaced.
    """
    made = ("n_tokens", "ids_sha256", "decoded_sha256") if digests else ("n_tokens", "ids", "decoded")
    docs = docs.drop(*made)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary.load(vocabulary, pattern)
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part, n, first, second = b.slice(i, 500), [], [], []
                for text in part.column(text_col):
                    ids = v.encode(text.as_py() or "")
                    decoded = v.decode(ids)
                    n.append(len(ids) // 4)
                    first.append(hashlib.sha256(ids).hexdigest() if digests else ids)
                    second.append(hashlib.sha256(decoded).hexdigest() if digests else decoded)
                kind = pa.string() if digests else pa.binary()
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64()), pa.array(first, kind), pa.array(second, kind)], names=[*names, *made])

    kind = "string" if digests else "binary"
    schema = docs.withColumns({made[0]: F.lit(0).cast("long"), made[1]: F.lit(None).cast(kind), made[2]: F.lit(None).cast(kind)}).schema
    return docs.mapInArrow(run, schema)
