"""Token ids of whole texts, by the tokenizers library, and files of them in the shared folder."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words of composed Latin letters, with a mark after them or not. Such letters are one token run, and the mark is another.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]?)")
_MARKS = ".,!?;:"
#: Words that a worker remembers with their ids at most; then it forgets them all.
MEMO = 1_500_000


class WordEncoder:
    """Ids of whole texts by a tokenizer whose normaliser and splitter treat words between white space on their own.

    Texts are cut at ASCII white space, which no normalised sign or match of the splitter reaches across. The distinct words
    of a run of texts are encoded once by the library, and remembered; texts are put together from their words' ids.
    Only words of composed Latin letters are lowered and freed of a mark before, as the tokenizer does itself, and encoded
    many in one text, whose word ends tell them apart; all others, with combining marks or special tokens, go to the
    library one by one and unchanged.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        #: Entries are runs of ids: that of no ids, one for each mark, then words.
        self.memo: dict[str, int] = {}
        self.cores: dict[str, int] = {}
        marks = self._one_by_one(list(_MARKS))
        self.flat = np.concatenate(marks)
        self.sizes = np.array([0, *map(len, marks)], dtype=np.int64)

    def _one_by_one(self, words: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for i in range(0, len(words), 4096) for e in self.tokenizer.encode_batch_fast(words[i : i + 4096], add_special_tokens=False)]

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are one token run each, one after the other, and how many each has."""
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, dtype="<u4")
        at = np.flatnonzero(self.ends[ids]) + 1
        if len(at) == len(words):
            return ids, np.diff(at, prepend=0)
        each = self._one_by_one(words)
        return np.concatenate(each), np.array([len(x) for x in each])

    def _add(self, ids: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        self.flat, self.sizes = np.concatenate([self.flat, *ids]), np.concatenate([self.sizes, *sizes])

    def _kinds(self, kinds: list[str]) -> np.ndarray:
        """For each distinct word its entry, times 8, and the entry of its mark."""
        if len(self.memo) + len(kinds) > MEMO:
            self._forget()
        memo, cores, n = self.memo, self.cores, len(self.sizes)
        fresh, odd = [], []
        for w in kinds:
            if w not in memo:
                plain = _PLAIN.fullmatch(w)
                if plain:
                    core = plain[1].lower()
                    at = cores.get(core)
                    if at is None:
                        at = cores[core] = n + len(fresh)
                        fresh.append(core)
                    memo[w] = at * 8 + (_MARKS.index(plain[2]) + 1 if plain[2] else 0)
                elif w:
                    odd.append(w)
                else:
                    memo[w] = 0
        pairs = [self._together(fresh[i : i + 8192]) for i in range(0, len(fresh), 8192)]
        others = self._one_by_one(odd)
        memo.update((w, (n + len(fresh) + k) * 8) for k, w in enumerate(odd))
        if pairs or others:
            self._add([*(p[0] for p in pairs), *others], [*(p[1] for p in pairs), np.array([len(x) for x in others], dtype=np.int64)])
        return np.fromiter(map(memo.__getitem__, kinds), dtype=np.int64, count=len(kinds))

    def encode_flat(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin (one more entry than texts)."""
        words = pc.ascii_split_whitespace(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        coded = pc.dictionary_encode(words.flatten())
        word = self._kinds(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        entry = np.column_stack([word >> 3, word & 7]).ravel()
        sizes = self.sizes[entry]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        shift = np.repeat((np.cumsum(self.sizes) - self.sizes)[entry] - ends[:-1], sizes)
        begin = np.concatenate(([0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))))
        return self.flat[shift + np.arange(ends[-1])], ends[2 * begin]

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        ids, at = self.encode_flat(texts)
        return [ids[a:b] for a, b in zip(at[:-1], at[1:])]

    def encode_ended(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end_id after each text's, and how many each text has with it."""
        ids, at = self.encode_flat(texts)
        out = np.insert(ids, at[1:], np.uint32(end_id))
        return out, np.diff(at) + 1


def runs(texts: pa.Array, size: int = 1 << 22) -> Iterator[tuple[int, pa.Array]]:
    """Runs of texts of about so many bytes, with the place of the first."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + size, "right")))
        yield i, texts.slice(i, j - i)
        i = j


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder and the path in it."""
    if not urlparse(uri).scheme:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, write) -> None:
    """write(stream) fills a file that appears under its name only when it is whole, so a repeated task may write it again."""
    fs, path = open_store(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.part-{os.getpid()}-{np.random.default_rng().integers(1 << 62):x}"
    with fs.open_output_stream(part) as f:
        write(f)
    fs.move(part, path)


def read_file(uri: str):
    fs, path = open_store(uri)
    return fs.open_input_file(path)
