"""Token ids of whole texts by a public tokenizer, with each distinct word encoded once per worker.

The tokenizer lower-cases, drops white space and cuts texts into words before it merges
bytes, so a text's ids are its words' ids in a row. Cutting and looking up are array
operations; only words not seen before go through the library.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np

from brinedeck.llm.common import ship, worker_cache

#: Words that a worker remembers at most; beyond it the memory starts anew (about 40 bytes a word).
REMEMBERED = 2_000_000
#: Bytes of text that are cut at a time.
CHUNK = 8 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)

ship(__name__)


def read_tokenizer(path: str) -> str:
    """The tokenizer's JSON, read once on the driver (a few MB) and sent to the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def id_width(tokenizer: str) -> int:
    """Bytes that any id of the tokenizer needs: 2 or 4."""
    content = json.loads(tokenizer)
    top = max([*content["model"]["vocab"].values(), *(x["id"] for x in content.get("added_tokens", []))])
    return 2 if top < 1 << 16 else 4


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """By byte: 0 white space, 1 letter, 2 digit, 3 other, 9 not handled here; and its lower case."""
    kind = np.full(256, 9, np.uint8)
    kind[33:127] = 3
    kind[48:58] = 2
    kind[[9, 10, 11, 12, 13, 32]] = 0
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    kind[65:91] = kind[97:123] = 1
    return kind, lower


class WordTokenizer:
    """Encodes texts with a tokenizer whose words are cut by letters, digits and other signs after lower-casing.

    Texts of ASCII and Latin-1 letters are cut with arrays; any other text goes to the
    library word by word. Both give exactly the ids of ``Tokenizer.encode``.
    """

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        parsed = json.loads(content)
        suffix = parsed["model"].get("end_of_word_suffix")
        shape = json.dumps([parsed.get("normalizer"), parsed.get("pre_tokenizer")])
        #: Cutting by arrays is right only for this word rule.
        self.cuts = bool(suffix) and "Lowercase" in shape and r"'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in shape
        if suffix:
            self.ends[[i for w, i in vocabulary.items() if w.endswith(suffix)]] = True
        self.special = [x["content"] for x in parsed.get("added_tokens", [])]
        self.kind, self.lower = _byte_classes()
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def slow(self, text: str) -> np.ndarray:
        """A text outside the array rule, in pieces that end at white space so that a huge text needs no huge encoding."""
        if len(text) <= 1 << 16 or not self.cuts:
            return self.plain(text)
        out, start = [], 0
        while start < len(text):
            end = min(len(text), start + (1 << 16))
            while end < len(text) and text[end] not in " \t\n\r\x0b\x0c":
                end += 1
            out.append(self.plain(text[start:end]))
            start = end
        return np.concatenate(out)

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text; null texts have none."""
        batch, held = [], 0
        for text in texts:
            raw = (text or "").encode()
            batch.append((text or "", raw))
            held += len(raw)
            if held >= CHUNK:
                yield from self._batch(batch)
                batch, held = [], 0
        yield from self._batch(batch)

    def _batch(self, batch: list[tuple[str, bytes]]) -> Iterator[np.ndarray]:
        if not batch:
            return
        joined = b"\n".join(raw for _, raw in batch) + b"\n" + b" " * 16
        data = np.frombuffer(joined, np.uint8).copy()
        lengths = np.array([len(raw) + 1 for _, raw in batch])
        edges = np.concatenate(([0], np.cumsum(lengths)))
        kind = self.kind[data]
        accent = np.flatnonzero(data == 0xC3)
        follow = data[accent + 1]
        good = (follow >= 0x80) & (follow <= 0xBF) & (follow != 0x97) & (follow != 0xB7)
        kind[accent[good]] = 1
        kind[accent[good] + 1] = 1
        low = self.lower[data]
        upper = accent[good & (follow <= 0x9E)] + 1
        low[upper] += 0x20
        odd = np.zeros(len(batch), bool)
        if self.cuts:
            odd[np.searchsorted(edges, np.flatnonzero(kind == 9), "right") - 1] = True
        else:
            odd[:] = True
        for mark in self.special:
            odd |= np.array([mark in text for text, _ in batch])
        if odd.all():
            for text, _ in batch:
                yield self.slow(text)
            return
        starts, ends = self._cut(low, kind)
        ids, at = self._look_up(low, starts, ends, kind)
        first = np.searchsorted(starts, edges)
        for k, (text, _) in enumerate(batch):
            yield self.slow(text) if odd[k] else ids[at[first[k]] : at[first[k + 1]]]

    @staticmethod
    def _cut(low: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words start and end: runs of one class, single digits, and the contractions the rule names."""
        new = np.empty(len(kind), bool)
        new[0] = True
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        mark = np.flatnonzero((low[:-3] == 39) & new[:-3])
        if len(mark):
            a, b = low[mark + 1], low[mark + 2]
            long = np.zeros(len(mark), np.int64)
            long[np.isin(a, np.frombuffer(b"stmd", np.uint8))] = 1
            long[((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)] = 2
            mark, long = mark[long > 0], long[long > 0]
            new[mark + 1] = False
            after = mark + 1 + long
            new[after] = True
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(kind))
        real = kind[starts] != 0
        return starts[real], ends[real]

    @staticmethod
    def _keys(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit key of each word's bytes and length."""
        window = np.ndarray(len(low) - 7, "<u8", low, strides=(1,))
        size = ends - starts
        key = size.astype(np.uint64) * _MIX2
        rest = np.arange(len(starts))
        step = 0
        while len(rest):
            left = size[rest] - step
            part = window[np.minimum(starts[rest] + step, len(window) - 1)]
            short = left < 8
            part[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
            mixed = (key[rest] ^ part) * _MIX
            mixed ^= mixed >> np.uint64(29)
            key[rest] = mixed * _MIX2 ^ (mixed >> np.uint64(32))
            rest = rest[left > 8]
            step += 8
        return key

    def _look_up(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each word's begin (one more entry at the end)."""
        keys = self._keys(low, starts, ends)
        distinct, one, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self.forget()
        place = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        known = self.keys[place] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        if not known.all():
            self._learn(low, starts, ends, kind, distinct[~known], one[~known])
            place = np.searchsorted(self.keys, distinct)
        n, at = self.n[place][which], self.at[place][which]
        out = np.concatenate(([0], np.cumsum(n)))
        source = np.repeat(at - out[:-1], n) + np.arange(out[-1])
        return self.pool[source], out

    def _learn(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: np.ndarray, keys: np.ndarray, one: np.ndarray) -> None:
        raw = low.tobytes()
        use = np.flatnonzero(kind[starts[one]] != 9)
        spelt = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[one[use]].tolist(), ends[one[use]].tolist(), strict=True)]
        sizes, made = np.zeros(len(one), np.int64), []
        for at in range(0, len(spelt), 25_600):
            block = spelt[at : at + 25_600]
            lines = [" ".join(block[i : i + 256]) for i in range(0, len(block), 256)]
            ids = np.array([i for x in self.library.encode_batch_fast(lines, add_special_tokens=False) for i in x.ids], np.uint32)
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) != len(block):  # a word without an end mark: one by one
                single = [self.plain(w) for w in block]
                ids, cut = np.concatenate(single), np.cumsum([len(x) for x in single])
            made.append(ids)
            sizes[use[at : at + 25_600]] = np.diff(cut, prepend=0)
        at = len(self.pool) + np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
        self.pool = np.concatenate([self.pool, *made])
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.n = keys[order], np.concatenate([self.at, at])[order], np.concatenate([self.n, sizes])[order]


def encoder(content: str) -> WordTokenizer:
    """This worker's tokenizer, kept between tasks."""
    return worker_cache(f"tokenizer {hash(content)}", lambda: WordTokenizer(content))


def encode_column(encoder: WordTokenizer, texts: Iterable[str | None], end_id: int) -> Iterator[np.ndarray]:
    """Ids of each text, closed by ``end_id``."""
    end = np.array([end_id], np.uint32)
    for ids in encoder.encode(list(texts)):
        yield np.concatenate((ids, end))
