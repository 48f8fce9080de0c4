"""Byte-level BPE encoding and decoding as a reduction over a monoid of token runs.

A text is halved until its parts are leaves; a leaf is encoded on its own; two neighbours are joined by re-encoding
a window around their seam, which grows until the tokens outside it are proven final:

* Between a character that isn't white space and one that is, the splitting pattern always ends a match, whatever
  stands before or after. Tokens beyond such a point on either side of the seam can't change, so the window may end there.
* Inside one long run of letters, digits or other signs there is no such point. There the run is one match on both
  sides, and a sequence of tokens is the encoding of its bytes if and only if each pair of neighbours is the encoding
  of that pair's bytes. The window grows by tokens until the pairs at both of its edges hold.

Decoding concatenates the bytes of the halves up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hivelens.llm.common import appended

LEAF_CHARS = 2048
WINDOW_CHARS = 32
#: Windows this long without a point that always ends a match turn to the rule for pairs.
LONG_RUN = 1024
#: White space as the splitting pattern's engine knows it.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_POINT = re.compile(f"(?<=[^{_WHITE}])(?=[{_WHITE}])")
_CLASS = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"[^" + _WHITE + r"\p{L}\p{N}]+")]


class Encoder:
    """Encodes and decodes whole texts by a rank file."""

    def __init__(self, path: str, pattern: str, leaf_chars: int = LEAF_CHARS):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.bytes_of[i] = b
        self.decimal = pa.array([f"{i} " for i in range(len(self.bytes_of))], pa.large_string())
        self.leaf_chars = max(1, leaf_chars)

    # -- encoding

    def encode(self, text: str) -> list[int]:
        return self._run(text, 0, len(text))

    def _run(self, text: str, a: int, b: int) -> list[int]:
        if b - a <= self.leaf_chars:
            return self.core.encode_ordinary(text[a:b])
        m = (a + b) // 2
        return self.join(text, a, m, b, self._run(text, a, m), self._run(text, m, b))

    def join(self, text: str, a: int, m: int, b: int, left: list[int], right: list[int]) -> list[int]:
        """The tokens of text[a:b] from those of text[a:m] and of text[m:b]."""
        width = WINDOW_CHARS
        while True:
            s, t = max(a, m - width), min(b, m + width)
            if s > a:
                s = next((x.start() for x in _POINT.finditer(text, s, m)), None)
            if t < b:
                found = _POINT.search(text, m + 1, t + 1)
                t = found.start() if found and m < found.start() < b else None
            if s is not None and t is not None:
                return self._splice(text, s, m, t, left, right)
            if width >= LONG_RUN and (out := self._join_inside(text, a, m, b, left, right)) is not None:
                return out
            width *= 2

    def _splice(self, text: str, s: int, m: int, t: int, left: list[int], right: list[int]) -> list[int]:
        drop_left, drop_right = len(text[s:m].encode()), len(text[m:t].encode())
        i, n = len(left), 0
        while n < drop_left:
            i -= 1
            n += len(self.bytes_of[left[i]])
        j, k = 0, 0
        while k < drop_right:
            k += len(self.bytes_of[right[j]])
            j += 1
        if n != drop_left or k != drop_right:
            raise AssertionError("a window must end between tokens")
        del left[i:]
        left += self.core.encode_ordinary(text[s:t])
        left += right[j:] if j else right
        return left

    def _join_inside(self, text: str, a: int, m: int, b: int, left: list[int], right: list[int]) -> list[int] | None:
        """The join inside one long run of a class; None if the seam isn't deep enough inside one."""
        s, t = max(a, m - LONG_RUN), min(b, m + LONG_RUN)
        if m - s < LONG_RUN or t - m < LONG_RUN or not any(c.fullmatch(text, s, t) for c in _CLASS):
            return None
        if left is right:
            right = list(right)
        room = LONG_RUN // 2
        i, j = len(left) - 2, 2
        while True:
            window = b"".join(self.bytes_of[x] for x in left[i:]) + b"".join(self.bytes_of[x] for x in right[:j])
            if len(window) > 2 * room or i < 1 or j >= len(right):
                return None
            ids = self.core._encode_single_piece(window)
            ok_left, ok_right = self._pair(left[i - 1], ids[0]), self._pair(ids[-1], right[j])
            if ok_left and ok_right:
                return left[:i] + ids + right[j:]
            i -= 2 * (not ok_left)
            j += 2 * (not ok_right)

    def _pair(self, x: int, y: int) -> bool:
        return list(self.core._encode_single_piece(self.bytes_of[x] + self.bytes_of[y])) == [x, y]

    def digest(self, ids: list[int]) -> str:
        """SHA-256 of the decimal ids, joined by one space."""
        if not ids:
            return hashlib.sha256(b"").hexdigest()
        joined = self.decimal.take(pa.array(ids, pa.int32()))
        end = np.frombuffer(joined.buffers()[1], dtype=np.int64)[len(ids)]
        return hashlib.sha256(memoryview(joined.buffers()[2])[: end - 1]).hexdigest()

    # -- decoding

    def decode(self, ids: list[int]) -> bytes:
        return self._decode(ids, 0, len(ids))

    def _decode(self, ids: list[int], a: int, b: int) -> bytes:
        if b - a <= 4096:
            return self.core.decode_bytes(ids[a:b])
        m = (a + b) // 2
        return self._decode(ids, a, m) + self._decode(ids, m, b)


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str, leaf_chars: int = LEAF_CHARS) -> Encoder:
    return Encoder(path, pattern, leaf_chars)


def bpe_encode(docs: DataFrame, path: str, pattern: str, text: str = "text", leaf_chars: int = LEAF_CHARS, keep_ids: bool = True) -> DataFrame:
    """docs with the BPE encoding of each whole text and a digest of its decoding.

    Adds ids (array of int; left out unless keep_ids), n_tokens, ids_sha256 (lowercase hex of the decimal ids joined by
    one space) and decoded_sha256 (of the decoded bytes). A missing or empty text has no ids; a missing id, repeated
    rows and ties don't matter, as each row is encoded on its own. Input columns of these names give way to the results.
    Very long texts take memory in proportion to their length and time in proportion to it times its logarithm at most.
    An empty table gives an empty table.
    """
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType(), False))] if keep_ids else []
    fields += [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]

    def make():
        enc = encoder(path, pattern, leaf_chars)

        def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            ids_of, counts, shas, backs = [], [], [], []
            for value in batch.column(text):
                ids = enc.encode(value.as_py() or "")
                counts.append(len(ids))
                shas.append(enc.digest(ids))
                backs.append(hashlib.sha256(enc.decode(ids)).hexdigest())
                if keep_ids:
                    ids_of.append(np.array(ids, dtype=np.int32))
            out = {"n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(shas, pa.string()), "decoded_sha256": pa.array(backs, pa.string())}
            if keep_ids:
                out["ids"] = pa.array(ids_of, pa.list_(pa.field("element", pa.int32(), nullable=False)))
            return out

        return run

    return appended(docs, make, fields)
