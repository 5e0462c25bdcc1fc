"""Token ids of whole texts with the ``tokenizers`` library, one word encoded once per worker.

A text's ids are the ids of its ASCII-white-space separated chunks in order, as long as the tokenizer
lower-cases, splits at white space and knows no added token with a blank in it. Whether that holds is
read from the tokenizer's file (``splits_at_space``); for any other file every text goes to the library
whole. So does, whatever the file, every text that holds an added token in any case: the library looks
for those before it lower-cases.

Chunks are cut, lower-cased (A-Z) and told apart in Arrow. Each Python worker keeps a bounded cache
from chunks to ids; what the cache lacks is encoded in one batch.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks that a worker keeps at most; the cache starts anew beyond it.
CACHE_CHUNKS = 450_000
#: Bytes of text that are encoded at once.
SLICE_BYTES = 4_000_000
_TAIL = ".,;:!?*$%&#|"
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")

_encoders: dict = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def splits_at_space(spec: dict) -> bool:
    """Whether a tokenizer file's rules lower-case the text, and never join what white space parts."""
    rules = (spec.get("normalizer") or {}).get("normalizers", [])
    folds = [n.get("type") for n in rules] == ["NFC", "Replace", "Lowercase"] and rules[1].get("pattern") == {"Regex": "\\s+"} and rules[1].get("content") == " "
    parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    cuts = [p.get("type") for p in parts] == ["Split", "ByteLevel"] and parts[0].get("behavior") == "Removed" and parts[0].get("invert") is True and not parts[1].get("add_prefix_space")
    # every alternative of the splitter is made of characters that are no white space
    cuts = cuts and parts[0].get("pattern") == {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}
    plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) and not any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens", []))
    return folds and cuts and plain and not spec.get("truncation") and not spec.get("padding") and not spec["model"].get("dropout")


class ChunkEncoder:
    """Encodes string arrays to one flat id array and lengths."""

    def __init__(self, path: str, cap: int = CACHE_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok, self.cap, self.by_chunk = Tokenizer.from_file(path), cap, splits_at_space(spec)
        self.added = [t["content"].lower() for t in spec.get("added_tokens", [])]
        ids = max(self.tok.get_vocab(with_added_tokens=True).values(), default=0)
        self.dtype = np.uint16 if ids < 1 << 16 else np.uint32
        suffix = spec["model"].get("end_of_word_suffix") or ""
        #: Whether an id ends a split of the splitter.
        self.last = np.zeros(ids + 1, bool)
        self.last[[i for t, i in self.tok.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.start, self.size = np.zeros(1 << 16, self.dtype), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.used = 0

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), self.dtype, int(size.sum())), size

    def _put(self, chunks: list[str], flat: np.ndarray, size: np.ndarray) -> None:
        n, more = len(self.index), len(chunks)
        while n + more > len(self.start):
            self.start, self.size = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.size))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.size[n : n + more] = size
        self.start[n : n + more] = self.used + np.cumsum(size) - size
        self.used += len(flat)
        self.index.update(zip(chunks, range(n, n + more)))

    def _take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the cached chunks at these places, and where each begins (and the last ends)."""
        size, start = self.size[at], self.start[at]
        upto = np.concatenate([[0], np.cumsum(size)])
        return self.flat[np.repeat(start - upto[:-1], size) + np.arange(upto[-1])], upto

    def _learn(self, chunks: list[str]) -> None:
        """Cache the ids of new chunks; an ending of ASCII punctuation after an ASCII letter or digit is a split of its own."""
        parts = [(c.rstrip(_TAIL), c) for c in chunks]
        parts = [(h, c[len(h) :]) if h and len(h) < len(c) and h[-1] in _ALNUM else (c, "") for h, c in parts]
        new = dict.fromkeys(p for pair in parts for p in pair if p not in self.index)
        letters = [p for p in new if p.isalpha()]
        other = [p for p in new if not p.isalpha()]
        for k in range(0, len(letters), 2000):
            some = letters[k : k + 2000]
            flat = np.fromiter(self.tok.encode(" ".join(some), add_special_tokens=False).ids, self.dtype)
            ends = np.flatnonzero(self.last[flat])
            # a word gives one split at least: as many splits as words mean one for each
            self._put(some, *((flat, np.diff(np.r_[-1, ends])) if len(ends) == len(some) else self._library(some)))
        if other:
            self._put(other, *self._library(other))
        whole = [(c, h, t) for c, (h, t) in zip(chunks, parts) if t]
        if whole:
            at = np.array([self.index[p] for _, h, t in whole for p in (h, t)])
            flat, upto = self._take(at)
            self._put([c for c, _, _ in whole], flat, np.diff(upto[::2]))

    def _chunks(self, lower: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(lower)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.index) > self.cap:
            self._reset()
        index = self.index
        new = [w for w in words if w not in index]
        if new:
            self._learn(new)
        known = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        at = known[coded.indices.to_numpy(zero_copy_only=False)]
        flat, upto = self._take(at)
        ends = split.offsets.to_numpy() - split.offsets[0].as_py()
        return flat, np.diff(upto[ends])

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each text's ids; null counts as empty."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        if not self.by_chunk:
            return self._library(texts.to_pylist())
        lower = pc.ascii_lower(texts)
        odd = np.zeros(len(texts), bool)
        for t in self.added:
            odd |= pc.match_substring(lower, t).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._chunks(lower)
        usual, size = self._chunks(lower.filter(pa.array(~odd)))
        whole, whole_size = self._library(texts.filter(pa.array(odd)).to_pylist())
        sizes = np.empty(len(texts), np.int64)
        sizes[~odd], sizes[odd] = size, whole_size
        flat, here = np.empty(int(sizes.sum()), self.dtype), np.repeat(odd, sizes)
        flat[~here], flat[here] = usual, whole
        return flat, sizes

    def encode_ended(self, texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with ``end_id`` after every text."""
        flat, size = self.encode(texts)
        ends = np.cumsum(size) + np.arange(len(size))
        out = np.empty(len(flat) + len(size), np.promote_types(self.dtype, np.min_scalar_type(end_id)))
        here = np.ones(len(out), bool)
        here[ends] = False
        out[here], out[ends] = flat, end_id
        return out, size + 1


def encoder(path: str) -> ChunkEncoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def arrow_slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut to slices of about so many bytes in a string or binary column, so that memory follows this bound and not the batch."""
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < len(upto):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + size, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def slices(texts: list, chars: int = SLICE_BYTES):
    """Index ranges of about so many characters of a list of texts."""
    lo = used = 0
    for i, t in enumerate(texts):
        used += len(t or "")
        if used >= chars:
            yield lo, i + 1
            lo, used = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
