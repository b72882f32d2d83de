"""Token ids of whole Arrow columns: a vectorised splitter in front of a byte-level BPE.

The pre-tokens of a slice are found with array operations, looked up by hash among
those this worker has met, and only new ones are encoded. Texts with characters
outside Latin letters and plain signs, or with an added token's content (`<|endoftext|>`),
go to the tokenizer itself, whole.
"""

from __future__ import annotations

import base64
import json
import unicodedata
from functools import lru_cache

import numpy as np

from lamina.llm.texts import HashIndex, Rolling, Slice, mix

LETTER, NUMBER, OTHER, SPACE, EDGE = range(5)
_PLAIN = 0x250  # code points below, and the signs of U+2010 to U+2027, are split here
_SIGNS = (0x2010, 0x2028)
_EDGE = 0x10FFFF
_KEPT = 4_000_000  # pre-tokens a worker remembers before it starts anew


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point up to the last one split here."""
    out = np.full(_SIGNS[1], OTHER, np.uint8)
    for i in (*range(_PLAIN), *range(*_SIGNS)):
        kind = unicodedata.category(chr(i))[0]
        out[i] = {"L": LETTER, "N": NUMBER}.get(kind, OTHER)
    out[[*range(9, 14), 0x20, 0x85, 0xA0]] = SPACE
    return out


def bounds(points: np.ndarray) -> np.ndarray:
    """Starts of pre-tokens in code points; texts are set apart by `_EDGE`, a pre-token of its own."""
    kind = _classes()[np.minimum(points, _SIGNS[1] - 1)]
    kind = np.where(points == _EDGE, EDGE, kind).astype(np.uint8)
    before = np.concatenate([[EDGE], kind[:-1]])
    after = np.concatenate([kind[1:], [EDGE]])
    blank = points == 0x20
    blank_before = np.concatenate([[False], blank[:-1]])
    space = kind == SPACE
    starts = (kind != before) & ~(blank_before & ~space & (kind != EDGE))
    # The last of several blanks goes with what follows, unless the text ends there.
    starts |= space & (before == SPACE) & (after != SPACE) & (after != EDGE)
    starts |= kind == EDGE
    starts[0] = True
    quote = np.flatnonzero((points == 0x27) & (before != OTHER) & ~blank_before)
    if len(quote):
        ahead = np.concatenate([points, np.full(3, _EDGE, points.dtype)])
        one, two = ahead[quote + 1], ahead[quote + 2]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            double |= (one == ord(a)) & (two == ord(b))
        short = quote[single | double]
        starts[short] = True
        starts[short + 1] = False
        double &= ~single
        starts[quote[double] + 2] = False
        ends = np.concatenate([quote[single] + 2, quote[double] + 3])
        ends = ends[ends < len(points)]
        # What follows the contraction starts anew; a blank or sign there does so anyway.
        starts[ends] = True
        space_run = ends[(kind[ends] == SPACE)]
        starts[space_run] = True
    return np.flatnonzero(starts)


class Encoder:
    """Token ids with a tokenizers file; `rank_file` holds the same vocabulary as ranks.

    Without it every new pre-token is encoded by `tokenizers`, which is slower.
    """

    def __init__(self, file: str, rank_file: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in spec.get("added_tokens") or [] if t["content"]]
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
            raise ValueError("a byte-level BPE without prefix blank is needed")
        self.piece = self._by_tokenizer
        if rank_file:
            import tiktoken

            with open(rank_file, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            whole = tiktoken.Encoding("ranks", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
            self.piece = whole.encode_ordinary
        self._forget()

    def _by_tokenizer(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _forget(self) -> None:
        self.index = HashIndex()
        self.where = np.zeros(1, np.int64)  # of known pre-token i: ids[where[i]:where[i + 1]]
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        new = [self.piece(t) for t in texts]
        known = len(self.where) - 1
        self.index.add(keys, np.arange(known, known + len(keys)))
        counts = np.array([len(x) for x in new], np.int64)
        self.where = np.concatenate([self.where, self.where[-1] + np.cumsum(counts)])
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in new for i in x), np.uint32, int(counts.sum()))])

    def encode(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice's rows, one after the other, and the number of each row's."""
        raw = part.data.tobytes()
        rows = [raw[a:b].decode("utf-8", "replace")
                for a, b in zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist(), strict=True)]
        text = chr(_EDGE).join(rows) + chr(_EDGE)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        edges = np.flatnonzero(points == _EDGE)
        odd = (points >= _PLAIN) & ((points < _SIGNS[0]) | (points >= _SIGNS[1])) & (points != _EDGE)
        if odd.any() or len(edges) != len(rows) or any(t in text for t in self.added):
            return self._mixed(part, rows, points, edges, odd)
        return self._plain(text, points, edges)

    def _mixed(self, part, rows, points, edges, odd) -> tuple[np.ndarray, np.ndarray]:
        """Rows with other characters or added tokens go to the tokenizer, the rest as ever."""
        fits = [(r.isascii() or all(ord(c) < _PLAIN or _SIGNS[0] <= ord(c) < _SIGNS[1] for c in r))
                and not any(t in r for t in self.added) for r in rows]
        plain = [r for r, f in zip(rows, fits, strict=True) if f]
        done = iter([])
        if plain:
            text = chr(_EDGE).join(plain) + chr(_EDGE)
            flat, counts = self._plain(text, (p := np.frombuffer(text.encode("utf-32-le"), np.uint32)),
                                       np.flatnonzero(p == _EDGE))
            done = iter(np.split(flat, np.cumsum(counts)[:-1]))
        out = [next(done) if f else np.array(self._by_tokenizer(r), np.uint32)
               for r, f in zip(rows, fits, strict=True)]
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), np.array([len(x) for x in out], np.int64)

    def _plain(self, text: str, points: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.where) > _KEPT:
            self._forget()
        starts = bounds(points)
        ends = np.append(starts[1:], len(points))
        real = points[starts] != _EDGE
        starts, ends = starts[real], ends[real]
        keys = Rolling(mix(points.astype(np.uint64) + np.uint64(1)))(starts, ends)
        found = self.index.find(keys)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, at = np.unique(keys[missing], return_index=True)
            at = missing[at]
            self._learn(new, [text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            found[missing] = self.index.find(keys[missing])
        counts = np.diff(self.where)[found]
        total = np.concatenate([[0], np.cumsum(counts)])
        flat = self.ids[np.repeat(self.where[found] - total[:-1], counts) + np.arange(total[-1])]
        upto = total[np.searchsorted(starts, edges)]
        return flat, np.diff(np.concatenate([[0], upto]))
