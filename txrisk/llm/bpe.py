"""Fast exact use of a byte-level BPE tokenizer of the ``tokenizers`` library.

The pre-tokenizer always starts a new piece at a space that a non-space character follows,
so a text can be cut there and every distinct chunk is encoded by the library once. A text
for which that does not hold (a space before white space or at its end, or a special
token's string in it) is encoded whole by the library.
"""

from __future__ import annotations

import os

import numpy as np

from txrisk.llm.textvec import Slice, hash_spans

#: A worker keeps at most this many chunks; more are encoded again when they come up.
CACHE_ENTRIES = 400_000
GROUP = 200

_WS_BYTE = np.zeros(256, bool)
_WS_BYTE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_WS_LEAD = np.zeros(256, bool)  # first bytes of the other white space characters
_WS_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        size = self.tok.get_vocab_size()
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        # in a byte-level vocabulary each character of a token stands for one byte
        self.width = np.array([len(self.tok.id_to_token(i) or "") for i in range(size)], np.int64)
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.known: dict[int, bytes] = {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype)

    def _odd_rows(self, s: Slice, space: np.ndarray) -> np.ndarray:
        buf = s.buf
        odd = np.zeros(s.rows, bool)
        padded = np.concatenate([buf, np.zeros(3, np.uint8)])
        nxt = padded[space + 1]
        bad = _WS_BYTE[nxt]
        for i in np.flatnonzero(_WS_LEAD[nxt]):
            rest = padded[space[i] + 1 : space[i] + 4].tobytes().decode("utf-8", "ignore")
            bad[i] = rest[:1].isspace()
        odd[np.searchsorted(s.off, space[bad], "right") - 1] = True
        full = np.flatnonzero(s.off[1:] > s.off[:-1])
        odd[full[buf[s.off[full + 1] - 1] == 0x20]] = True
        raw = buf.tobytes()
        for t in self.special:
            at = raw.find(t)
            while at >= 0:
                odd[np.searchsorted(s.off, at, "right") - 1] = True
                at = raw.find(t, at + 1)
        return odd

    def _learn(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each chunk; those that start with a space are encoded many in one string."""
        out: list[bytes] = [b""] * len(chunks)
        spaced = [i for i, c in enumerate(chunks) if c[:1] == b" "]
        alone = [i for i, c in enumerate(chunks) if c[:1] != b" "]
        groups = [spaced[i : i + GROUP] for i in range(0, len(spaced), GROUP)]
        texts = [b"".join([chunks[i] for i in g]).decode() for g in groups] + [chunks[i].decode() for i in alone]
        got = [np.array(e.ids, self.dtype) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        for g, ids in zip(groups, got, strict=False):
            ends = np.cumsum(self.width[ids])
            cut = np.searchsorted(ends, np.cumsum([len(chunks[i]) for i in g])) + 1
            raw, a = ids.tobytes(), 0
            for i, b in zip(g, (cut * self.dtype.itemsize).tolist(), strict=True):
                out[i] = raw[a:b]
                a = b
        for i, ids in zip(alone, got[len(groups) :], strict=True):
            out[i] = ids.tobytes()
        return out

    def encode(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): ids of all texts of a slice in order; text i has first[i]:first[i + 1]."""
        space = np.flatnonzero(s.buf == 0x20)
        odd = self._odd_rows(s, space)
        full = np.flatnonzero(s.off[1:] > s.off[:-1])
        start = np.sort(np.concatenate([s.off[full], space[~np.isin(space, s.off[full])]]))
        end = np.append(start[1:], s.buf.size)
        row = np.searchsorted(s.off, start, "right") - 1
        plain = ~odd[row]
        start, end, row = start[plain], end[plain], row[plain]
        uniq, where, inv = np.unique(hash_spans(s.buf, start, end), return_index=True, return_inverse=True)
        got = list(map(self.known.get, uniq.tolist()))
        miss = [i for i, g in enumerate(got) if g is None]
        if miss:
            at = where[miss]
            chunks = [s.buf[a:b].tobytes() for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
            room = CACHE_ENTRIES - len(self.known)
            for k, (i, ids) in enumerate(zip(miss, self._learn(chunks), strict=True)):
                got[i] = ids
                if k < room:
                    self.known[int(uniq[i])] = ids
        flat = np.frombuffer(b"".join(got), self.dtype)
        size = np.array([len(g) for g in got], np.int64) // self.dtype.itemsize
        pos = np.concatenate([[0], np.cumsum(size)])
        n = size[inv]
        count = np.bincount(row, n, s.rows).astype(np.int64)
        total = int(n.sum())
        begin = np.cumsum(n) - n
        ids = flat[np.repeat(pos[inv] - begin, n) + np.arange(total)] if total else flat[:0]
        if odd.any():
            first = np.concatenate([[0], np.cumsum(count)])
            parts = [self.whole(s.text(i)) if odd[i] else ids[first[i] : first[i + 1]] for i in range(s.rows)]
            count = np.array([len(p) for p in parts], np.int64)
            ids = np.concatenate(parts)
        return ids, np.concatenate([[0], np.cumsum(count)])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's own encoder; its chunk table lives as long as the worker does."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
