"""Vector bin packing: examples go into training sequences under limits on tokens, segments and loss-bearing tokens.

Texts are encoded where they are read and cut into pieces of at most one sequence. Pieces are dealt by a hash of
their document into packing groups of bounded size; a group is the unit of parallel work and of recovery. In a group
sequences are filled one after the other: of all pieces that still fit in every dimension the one whose demand
(tokens, one segment, loss-bearing tokens, each as a share of its limit) has the largest dot product with what is left
in the sequence goes next. Where none fits, a piece is cut to what is left; where a limit on segments or loss closes a
sequence early, it is trimmed to a power of two, which needs no padding, and the rest goes back to the pieces. A sequence is
therefore full or a power of two long, however few documents there are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.textkit import text_bytes


class Limits(NamedTuple):
    """Most tokens, pieces and loss-bearing tokens of one sequence."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


#: Bytes of text that a packing group aims at; id that ends a document.
GROUP_BYTES, END_ID = 16 << 20, 1
#: Characters that both encoders below class alike; texts with any other go to the tokenizer itself. Fixed ranges, every
#: character of which the tests hold against it.
ALIKE = "\u0000-\u0557\u058d-\u088e\u0890-\u0c5b\u0cdd-\u208e\u20a0-\ua7cd\uac00-\ud7a3\uf900-\ufa6d\ufe30-\ufe4f\uff01-\uff60\U0001f300-\U0001f64f"


def _byte_of() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=4)
def encoder(path: str):
    """(text to ids as bytes, their type) of a byte-level tokenizer file; strings of special tokens are ordinary text.

    Texts go through tiktoken with the tokenizer's own vocabulary as ranks, several times faster. Both merge
    the adjacent pair of the lowest rank; they could differ only where two tokens spell a third one that the tokenizer makes
    of another pair. Such a pair can only stand together in a text if it does so when the third is encoded alone, so
    nothing differs in a vocabulary whose every token encodes to itself (the tests try all of them).
    """
    import public_tokenizers
    import regex
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    kind, byte = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4", _byte_of()
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    ranks = {bytes(byte[c] for c in token): i for token, i in tokenizer.get_vocab().items() if token not in special}
    fast = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    odd = regex.compile(f"[^{ALIKE}]").search

    def encode(text: str) -> bytes:
        if text.isascii() or not odd(text):
            return np.array(fast(text), kind).tobytes()
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, kind).tobytes()

    return encode, kind


class Placed(NamedTuple):
    """A piece of item ``item``, its ids from ``start`` on, in sequence ``bin`` at ``offset``."""

    item: int
    start: int
    length: int
    bin: int
    offset: int


def pack(sizes: list[int], prompts: list[int], limits: Limits, cut: bool = True) -> list[Placed]:
    """Dot-product packing of items, the first ``prompts`` ids of which bear no loss.

    With ``cut`` items may be cut anywhere, and every sequence is full or a power of two long; without it no item may
    exceed a limit by itself.
    """
    if min(limits) < 1:
        raise ValueError("every limit is at least 1")
    if not cut and any(n > limits.tokens or max(0, n - p) > limits.loss for n, p in zip(sizes, prompts, strict=True)):
        raise ValueError("an item exceeds a limit by itself")
    kinds: dict[tuple[int, int], int] = {}
    tokens, prompt, loss, count = (np.zeros(64, np.int64) for _ in range(4))
    waiting: list[list[tuple[int, int]]] = []

    def put(item: int, start: int, n: int, p: int) -> None:
        nonlocal tokens, prompt, loss, count
        p = max(0, min(p, n))
        k = kinds.setdefault((n, p), len(kinds))
        if k == len(waiting):
            waiting.append([])
            if k == len(tokens):
                tokens, prompt, loss, count = (np.concatenate([a, np.zeros(len(a), np.int64)]) for a in (tokens, prompt, loss, count))
            tokens[k], prompt[k], loss[k] = n, p, n - p
        waiting[k].append((item, start))
        count[k] += 1

    # longest first, so that of pieces alike in demand the smallest number goes first
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], prompts[i], -i)):
        if sizes[i] > 0:
            put(i, 0, sizes[i], prompts[i])
    left, seq, out = sum(map(len, waiting)), 0, []
    while left:
        here: list[tuple[int, int, int, int]] = []
        room, seats, bear, filled = limits.tokens, limits.segments, limits.loss, 0
        while room and seats and left:
            n = len(waiting)
            some, t, v = count[:n] > 0, tokens[:n], loss[:n]
            demand = t * (room / limits.tokens**2) + seats / limits.segments**2 + v * (bear / limits.loss**2)
            fits = some & (t <= room) & (v <= bear)
            k = int(np.where(fits, demand, -1.0).argmax())
            take = int(t[k]) if fits[k] else 0
            if cut and (not take or (seats == 1 and take < room)):
                # no piece fits, or the last segment would leave room: cut one that is too long
                may = np.minimum(np.minimum(t, room), prompt[:n] + bear)
                may[~some] = 0
                j = int(np.where(may > take, may * 2.0 + demand / 4, -1.0).argmax())
                if may[j] > take:
                    k, take = j, int(may[j])
            if not take:
                break
            item, start = waiting[k].pop()
            count[k] -= 1
            p, rest = int(prompt[k]), int(t[k]) - take
            if rest:
                put(item, start + take, rest, p - take)
            else:
                left -= 1
            here.append((item, start, take, min(p, take)))
            room, seats, bear, filled = room - take, seats - 1, bear - max(0, take - p), filled + take
        if cut and room:
            # trim to a power of two; what is cut off waits again
            excess = filled - (1 << (filled.bit_length() - 1))
            while excess:
                item, start, n, p = here.pop()
                off = min(excess, n)
                if n > off:
                    here.append((item, start, n - off, min(p, n - off)))
                    left += 1
                else:
                    left += 1
                put(item, start + n - off, off, p - (n - off))
                excess -= off
        at = 0
        for item, start, n, _ in here:
            out.append(Placed(item, start, n, seq, at))
            at += n
        seq += 1
    return out


_PIECE = pa.schema([("start", pa.int64()), ("length", pa.int64()), ("prompt", pa.int64()), ("doc_tokens", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary())])
_OUT = pa.schema([
    ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("loss_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])


def _sql(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'bigint'}" for f in schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
    limits: Limits = Limits(), end_id: int = END_ID, group_bytes: int = GROUP_BYTES, with_ids: bool = False,
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, loss_tokens, sequence_id, offset[, ids]): one row per piece.

    A document's ids are those of its prompt (``prompt_col``, if there is one; they bear no loss), those of its text and
    ``end_id``; null texts count as empty, so every row has at least one id. Each id lies in exactly one piece, pieces
    of a sequence follow each other without a gap from offset 0, and a sequence is ``limits.tokens`` or a power of two
    long. ``ids_crc32`` is that of the piece's ids as little-endian unsigned 32-bit integers; ``with_ids`` adds them.

    Rows with different ids or texts are packed alike whatever the layout of the input; repeated rows are packed
    one by one, and which of their groups holds which copy follows the layout. Null ids are ids of their own and come
    last in their group. Further columns, whatever their names, are not read; an empty table gives no rows. Texts may be
    of any length: they leave their task as pieces of one sequence at most.
    """
    ids_type = dict(docs.select(id_col).dtypes)[id_col]
    prompt = F.col(prompt_col) if prompt_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"), F.coalesce(prompt, F.lit("")).alias("prompt_text"))
    sized = rows.select(F.concat("prompt_text", "text").alias("text")) if prompt_col else rows
    groups = max(1, -(-text_bytes(sized) // group_bytes))
    keyed = rows.withColumn("key", F.xxhash64("id", "prompt_text", "text"))

    def encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind = encoder(tokenizer)
        width, end, seen = np.dtype(kind).itemsize, np.array([end_id], kind).tobytes(), {}
        if end_id > np.iinfo(kind).max:
            raise ValueError("the ending id is no id of this tokenizer")
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                at, copy, cols = [], [], [[] for _ in _PIECE]
                for r, (text, before, key) in enumerate(zip(*(part.column(c).to_pylist() for c in ("text", "prompt_text", "key")), strict=True)):
                    seen[key] = nth = seen.get(key, -1) + 1
                    head = encode(before) if before else b""
                    ids = head + encode(text) + end
                    n, p = len(ids) // width, len(head) // width
                    # full sequences of their own are already known, where the other limits allow them
                    whole = limits.loss >= limits.tokens
                    for start in range(0, n, limits.tokens):
                        piece = ids[start * width : (start + limits.tokens) * width]
                        m = len(piece) // width
                        crc = zlib.crc32(np.frombuffer(piece, kind).astype("<u4").tobytes()) if whole and m == limits.tokens else None
                        at.append(r)
                        copy.append(nth)
                        for c, v in zip(cols, (start, m, max(0, min(p - start, m)), n, crc, piece if crc is None or with_ids else None), strict=True):
                            c.append(v)
                taken = part.select(["id", "key"]).take(pa.array(at, pa.int64()))
                made = [pa.array(c, f.type) for c, f in zip(cols, _PIECE, strict=True)]
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(copy, pa.int64()), *made], names=["id", "key", "copy", *_PIECE.names])

    pieces = keyed.mapInArrow(encode_rows, f"id {ids_type}, key bigint, copy bigint, {_sql(_PIECE)}")
    # copies of one row go to different groups
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("key", "copy"), F.lit(groups))).repartition(groups, "group")

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.sort_by([("id", "ascending"), ("key", "ascending"), ("copy", "ascending"), ("start", "ascending")])
        start, length, prompt, doc_tokens, crc, ids = (t[c].to_pylist() for c in _PIECE.names)
        full = [k for k in range(len(start)) if crc[k] is not None]
        rest = [k for k in range(len(start)) if crc[k] is None]
        told = [(k, 0, length[k], s, 0) for s, k in enumerate(full)]
        told += [(rest[p.item], p.start, p.length, len(full) + p.bin, p.offset) for p in pack([length[k] for k in rest], [prompt[k] for k in rest], limits)]
        first, made = key[0].as_py() << 32, []
        for k, s, n, seq, offset in told:
            own = None if ids[k] is None else np.frombuffer(ids[k], f"<u{len(ids[k]) // length[k]}")[s : s + n].astype("<u4").tobytes()
            sum32 = crc[k] if own is None else zlib.crc32(own)
            loss = max(0, n - max(0, prompt[k] - s))
            made.append((start[k] + s, n, sum32, doc_tokens[k], loss, first + seq, offset, own if with_ids else None))
        cols = list(zip(*made, strict=True)) or [()] * len(_OUT)
        return pa.Table.from_arrays([t["id"].take(pa.array([k for k, *_ in told], pa.int64())), *[pa.array(c, f.type) for c, f in zip(cols, _OUT, strict=True)]], names=["id", *_OUT.names])

    packed = dealt.groupBy("group").applyInArrow(run, f"id {ids_type}, {_sql(_OUT)}")
    return packed if with_ids else packed.drop("ids")
