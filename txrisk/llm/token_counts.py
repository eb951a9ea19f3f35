"""Token counts by a finite-state compilation of a byte-level BPE tokenizer.

Two deterministic transducers stand for the tokenizer.

* The *piece machine* reads code-point classes and marks where the pre-tokenizer starts a
  piece (11 states, 11 symbols; a mark may lie one symbol back). A slice of texts is cut into
  chunks of equal size. Every chunk becomes a map from state to state, the maps are composed
  by a parallel prefix scan, and with its start state known each chunk writes its marks. The
  end of a text (or a special token's string) is a symbol too, so one scan serves all texts.
* The *token machine* reads the bytes of a piece. BPE gives every prefix of a piece one last
  token, so a state is the set of places where the token being read may have begun, each
  with the token before it, and a transition is annotated with the change of the number of
  tokens: +1 where a token is opened, 0 where the last one grows, less where several merge.
  A token may follow another one if no merge rule crosses their border before both are
  complete; the two spines of merges decide that. States are made when first reached, for all
  pieces of a slice at once, and kept in a table of bounded size that is emptied when full.

Counts of pieces are summed by text. No token ids are made and the library encodes nothing:
it only says which code points its pre-tokenizer takes for letters, numbers and white space.

Defined cases: a null or empty text has 0 bytes and 0 tokens; special strings inside a text
count 1 each; very long texts and pieces are read whole; a null doc_id stays null; repeated
rows are counted each; an empty table gives no rows; bytes that are not UTF-8 count as U+FFFD;
other columns are ignored.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.bpe import default_tokenizer
from txrisk.llm.shared import ship, table
from txrisk.llm.textvec import Slice, slices

# symbols of the piece machine
LETTER, STMD, RV, ELL, EE, NUMBER, SPACE, WHITE, QUOTE, OTHER, END = range(11)
SYMBOLS = 11
# its states; APO_RV is "'r" or "'v" waiting for "e", APO_L "'l" waiting for "l"; RUN1 and RUNS
# are one and several white space characters, the last one a space (S) or another (W)
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, APO, APO_RV, APO_L, RUN1S, RUN1W, RUNSS, RUNSW = range(11)
STATES = 11
HERE, BEFORE = 1, 2  # a piece starts at this symbol, at the one before
LETTERS = (LETTER, STMD, RV, ELL, EE)
CHUNK = 192  # symbols; a multiple of 3, as three symbols are read at a time

MAX_STATES = 1 << 18  # the table is emptied between slices (in a long piece: between bytes) when it is full
SLOTS = 1 << 20
HASH, SHIFT = np.int64(0x1E3779B97F4A7C15), 40
LONG_PIECE = 48


def piece_machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, marks) by (state, symbol)."""
    step = np.zeros((STATES, SYMBOLS), np.uint8)
    marks = np.zeros((STATES, SYMBOLS), np.uint8)
    opened = {**dict.fromkeys(LETTERS, IN_LETTERS), NUMBER: IN_NUMBERS, SPACE: RUN1S, WHITE: RUN1W, QUOTE: APO, OTHER: IN_OTHERS, END: START}
    joined = {**dict.fromkeys(LETTERS, IN_LETTERS), NUMBER: IN_NUMBERS, QUOTE: IN_OTHERS, OTHER: IN_OTHERS}

    def put(state: int, symbols, to, mark: int) -> None:
        for c in symbols:
            step[state, c] = to[c] if isinstance(to, dict) else to
            marks[state, c] = mark

    every = range(SYMBOLS)
    for s in (START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, APO, RUN1W):
        put(s, every, opened, HERE)
    for s in (APO_RV, APO_L, RUNSW):
        put(s, every, opened, HERE | BEFORE)
    put(RUN1S, joined, joined, 0)
    put(RUNSS, joined, joined, BEFORE)
    put(IN_LETTERS, LETTERS, IN_LETTERS, 0)
    put(IN_NUMBERS, (NUMBER,), IN_NUMBERS, 0)
    for s in (IN_OTHERS, APO):
        put(s, (QUOTE, OTHER), IN_OTHERS, 0)
    for s in (APO_RV, APO_L):
        put(s, LETTERS, IN_LETTERS, BEFORE)
    put(APO, (STMD,), START, 0)
    put(APO, (RV,), APO_RV, 0)
    put(APO, (ELL,), APO_L, 0)
    put(APO_RV, (EE,), START, 0)
    put(APO_L, (ELL,), START, 0)
    for s in (RUN1S, RUN1W, RUNSS, RUNSW):
        put(s, (SPACE,), RUNSS, 0)
        put(s, (WHITE,), RUNSW, 0)
        put(s, (END,), START, HERE)
    return step, marks


STEP, MARKS = piece_machine()
#: State after three symbols, by state and the symbols as one number.
STEP3 = STEP[STEP[STEP]].reshape(-1).astype(np.intp)
_STEP1, _MARKS1 = STEP.reshape(-1).astype(np.intp), MARKS.reshape(-1)


def chunk_starts(symbols: np.ndarray) -> np.ndarray:
    """The state in which each chunk (a row) starts: chunk maps and their prefix scan."""
    triple = (symbols[:, 0::3].astype(np.int32) * SYMBOLS + symbols[:, 1::3]) * SYMBOLS + symbols[:, 2::3]
    maps = np.tile(np.arange(STATES, dtype=np.intp), (symbols.shape[0], 1))
    for j in range(triple.shape[1]):
        maps = STEP3[maps * SYMBOLS**3 + triple[:, j, None]]
    d = 1
    while d < maps.shape[0]:  # after a round, maps[i] spans the last 2d chunks up to i
        maps[d:] = np.take_along_axis(maps[d:], maps[:-d].copy(), axis=1)
        d *= 2
    return np.concatenate([[START], maps[:-1, START]])


def piece_marks(symbols: np.ndarray) -> np.ndarray:
    """True where a piece starts (the END symbols are pieces of their own)."""
    n = symbols.size
    grid = np.full(-(-max(n, 1) // CHUNK) * CHUNK, END, np.uint8)
    grid[:n] = symbols
    grid = grid.reshape(-1, CHUNK)
    state, marks = chunk_starts(grid), np.empty(grid.shape, np.uint8)
    for j in range(CHUNK):
        at = state * SYMBOLS + grid[:, j]
        marks[:, j] = _MARKS1[at]
        state = _STEP1[at]
    flat = marks.reshape(-1)[:n]
    start = (flat & HERE).astype(bool)
    start[:-1] |= (flat[1:] & BEFORE).astype(bool)
    return start


def code_point_symbols(path: str) -> bytes:
    """The symbol of every code point, compressed. Unicode categories give a first guess, and
    the library's own pre-tokenizer is asked whether it takes each block as one piece."""
    from tokenizers import Tokenizer

    pre = Tokenizer.from_file(path).pre_tokenizer
    kind = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))
        if k[0] == "L":
            kind[c] = LETTER
        elif k[0] == "N":
            kind[c] = NUMBER
        elif k[0] == "Z" or c in (9, 10, 11, 12, 13, 0x85):
            kind[c] = WHITE
    kind[0xD800:0xE000] = END  # surrogates are no text
    whole = lambda t: len(pre.pre_tokenize_str(t)) == 1
    for k in (LETTER, NUMBER, WHITE, OTHER):
        members = np.flatnonzero(kind == k)
        for lo in range(0, members.size, 4096):
            block = members[lo : lo + 4096].tolist()
            if whole("".join(map(chr, block))):
                continue
            for c in block:
                t = chr(c)
                if whole("a" + t):
                    kind[c] = LETTER
                elif whole("0" + t):
                    kind[c] = NUMBER
                else:
                    kind[c] = OTHER if whole("!" + t) else WHITE
    for symbol, chars in ((STMD, "stmd"), (RV, "rv"), (ELL, "l"), (EE, "e"), (SPACE, " "), (QUOTE, "'")):
        kind[[ord(c) for c in chars]] = symbol
    return zlib.compress(kind.tobytes())


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 is
    itself, the others are U+0100 and on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class TokenMachine:
    """The token machine of a byte-level BPE file, its states made when first reached."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd or spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError(f"not a plain byte-level BPE file: {path} {odd}")
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"added tokens with strip or word rules: {path}")
        names = sorted((t["content"].encode() for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, names))) if names else None
        self._spines(model)
        self._trie(model["vocab"])
        self.can_follow: dict[int, bool] = {}
        self.reset()

    def _spines(self, model: dict) -> None:
        """Merge rules, and for every token its symbols at either edge from one byte up to the
        whole, each with the rank of the rule that ends it."""
        vocab = model["vocab"]
        self.rules: dict[tuple[int, int], int] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.right: dict[int, list[tuple[int, int]]] = {}
        never = len(model["merges"])
        for c in byte_letters():
            self.left[vocab[c]] = self.right[vocab[c]] = [(vocab[c], never)]
        for rank, rule in enumerate(model["merges"]):
            a, b = rule.split(" ") if isinstance(rule, str) else rule
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if x not in self.left or y not in self.left or z in self.left:
                raise ValueError("a merge rule comes before its parts, or makes a token twice")
            self.rules[x, y] = rank
            whole = [] if self._crossed(x, y, True) else [(z, never)]
            # a token that its own bytes do not give is never emitted: its spines end early
            self.left[z] = [*self.left[x][:-1], (x, rank), *whole]
            self.right[z] = [*self.right[y][:-1], (y, rank), *whole]

    def _crossed(self, u: int, v: int, but_last: bool = False) -> bool:
        """Does a rule merge across the border of u and v before both are complete (or after,
        unless ``but_last``)? The leftmost of equal rules is applied first."""
        right, left = self.right[u], self.left[v]
        if right[-1][0] != u or left[-1][0] != v:
            return True
        i = j = 0
        while True:
            (r, ends_r), (l, ends_l) = right[i], left[j]
            last = i + 1 == len(right) and j + 1 == len(left)
            rank = self.rules.get((r, l))
            if rank is not None and rank < ends_r and rank <= ends_l and not (last and but_last):
                return True
            if last:
                return False
            if ends_r <= ends_l:
                i += 1
            else:
                j += 1

    def _trie(self, vocab: dict[str, int]) -> None:
        letters = byte_letters()
        self.child: dict[int, int] = {}
        self.token = [-1]
        inner = [False]
        for name, t in vocab.items():
            if t not in self.left or self.left[t][-1][0] != t:
                continue
            node = 0
            for b in map(letters.__getitem__, name):
                inner[node] = True
                nxt = self.child.setdefault(node << 8 | b, len(self.token))
                if nxt == len(self.token):
                    self.token.append(-1)
                    inner.append(False)
                node = nxt
            self.token[node] = t
        self.inner = inner

    def reset(self) -> None:
        """An empty table: the start state alone. Transitions lie in a hash table by edge
        (state and byte), as most states are left by two or three bytes only."""
        self.states = [(self._place(0, -1, 0),)]
        self.number = {self.states[0]: 0}
        self.edges = 0
        self.key, self.next, self.delta = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int16)

    @staticmethod
    def _place(node: int, before: int, k: int) -> int:
        """A place where the token being read may have begun, as one number: its trie node, the
        token before it and the tokens up to there, against those of the whole prefix."""
        return node << 40 | before + 1 << 16 | k + 0x8000

    def full(self) -> bool:
        return len(self.states) > MAX_STATES or 2 * self.edges > SLOTS

    def find(self, edge: np.ndarray) -> np.ndarray:
        """Slots of the edges in the table; new edges are learnt."""
        slot = (edge * HASH) >> SHIFT & SLOTS - 1
        miss = np.flatnonzero(self.key[slot] != edge)
        while miss.size:
            new = miss[self.key[slot[miss]] < 0]
            if new.size:
                for e in np.unique(edge[new]).tolist():
                    self.slot_of(e)
                miss = miss[self.key[slot[miss]] != edge[miss]]
            slot[miss] = slot[miss] + 1 & SLOTS - 1
            miss = miss[self.key[slot[miss]] != edge[miss]]
        return slot

    def slot_of(self, edge: int) -> int:
        slot = (edge * int(HASH) & 2**63 - 1) >> SHIFT & SLOTS - 1
        while (k := self.key.item(slot)) != edge:
            if k < 0:
                self.key[slot] = edge
                self.next[slot], self.delta[slot] = self.learn(edge)
                self.edges += 1
                break
            slot = slot + 1 & SLOTS - 1
        return slot

    def _follows(self, u: int, t: int) -> bool:
        key = u << 32 | t
        found = self.can_follow.get(key)
        if found is None:
            if len(self.can_follow) > 4 * MAX_STATES:
                self.can_follow.clear()
            found = self.can_follow[key] = not self._crossed(u, t)
        return found

    def learn(self, edge: int) -> tuple[int, int]:
        """Next state and change of the number of tokens, of state ``edge >> 8`` on byte ``edge & 255``."""
        b, live, last, count = edge & 255, [], -1, 0
        for place in self.states[edge >> 8]:
            c = self.child.get(place >> 40 << 8 | b)
            if c is None:
                continue
            t, before = self.token[c], (place >> 16 & 0xFFFFFF) - 1
            if t >= 0 and (before < 0 or self._follows(before, t)):
                last, count = t, (place & 0xFFFF) - 0x7FFF
            if self.inner[c]:
                live.append(c << 40 | place & 0xFFFFFFFFFF)
        state = (self._place(0, last, 0), *[p - count for p in live])
        to = self.number.get(state)
        if to is None:
            to = self.number[state] = len(self.states)
            self.states.append(state)
        return to, count

    def counts(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each piece."""
        size = end - start
        out = np.zeros(size.size, np.int64)
        short = np.flatnonzero(size <= LONG_PIECE)
        # a part adds a quarter of the slots at most, so a table below half full has room for it
        part = np.cumsum(size[short]) // (SLOTS // 4)
        for rows in np.split(short, np.flatnonzero(np.diff(part)) + 1):
            if self.full():
                self.reset()
            order = rows[np.argsort(-size[rows], kind="stable")]
            at, left = start[order], -size[order]
            state, total = np.zeros(order.size, np.int64), np.zeros(order.size, np.int64)
            for j in range(int(-left[0]) if order.size else 0):
                m = int(np.searchsorted(left, -j))  # pieces with more than j bytes
                slot = self.find(state[:m] << 8 | buf[at[:m] + j])
                total[:m] += self.delta[slot]
                state[:m] = self.next[slot]
            out[order] = total
        for i in np.flatnonzero(size > LONG_PIECE).tolist():
            out[i] = self._long(buf[start[i] : end[i]].tobytes())
        return out

    def _long(self, piece: bytes) -> int:
        state = total = 0
        for b in piece:
            if self.full():  # go on from this state alone
                kept = self.states[state]
                self.reset()
                state = self.number.setdefault(kept, 1)
                self.states += [kept] * state
            slot = self.slot_of(state << 8 | b)
            total += self.delta.item(slot)
            state = self.next.item(slot)
        return total


def valid(s: Slice) -> tuple[Slice, str]:
    """The slice and its code points; bytes that are no UTF-8 become U+FFFD."""
    try:
        return s, s.buf.tobytes().decode()
    except UnicodeDecodeError:
        texts = [s.text(i) for i in range(s.rows)]
        raw = [t.encode() for t in texts]
        off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        return Slice(s.lo, s.hi, np.frombuffer(b"".join(raw), np.uint8), off, s.null), "".join(texts)


def count_tokens(s: Slice, machine: TokenMachine, kinds: np.ndarray) -> np.ndarray:
    """Tokens of every text of a slice."""
    s, text = valid(s)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    at = np.flatnonzero((s.buf & 0xC0) != 0x80)  # first byte of every code point
    first = np.searchsorted(at, s.off)
    row = np.repeat(np.arange(s.rows), np.diff(first))
    # every text is followed by an END symbol
    symbol = np.full(points.size + s.rows, END, np.uint8)
    place = np.empty(symbol.size, np.int64)
    owner = np.empty(symbol.size, np.int64)
    own = np.arange(points.size) + row
    ends = first[1:] + np.arange(s.rows)
    symbol[own], place[own], owner[own] = kinds[points], at, row
    place[ends], owner[ends] = s.off[1:], np.arange(s.rows)
    specials = np.zeros(s.rows, np.int64)
    if machine.special is not None:
        keep = np.ones(symbol.size, bool)
        raw, r = s.buf.tobytes(), 0
        pos = 0
        while m := machine.special.search(raw, pos):
            r = int(np.searchsorted(s.off, m.start(), "right")) - 1
            if m.end() > s.off[r + 1]:  # it would reach into the next text
                pos = m.start() + 1
                continue
            a, b = np.searchsorted(at, [m.start(), m.end()]) + r
            symbol[a] = END
            keep[a + 1 : b] = False
            specials[r] += 1
            pos = m.end()
        symbol, place, owner = symbol[keep], place[keep], owner[keep]
    begin = np.flatnonzero(piece_marks(symbol))
    stop = np.append(begin[1:], symbol.size)
    piece = symbol[begin] != END
    begin, stop = begin[piece], stop[piece]
    n = machine.counts(s.buf, place[begin], place[stop]) if begin.size else np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(n)])
    return np.diff(total[np.searchsorted(owner[begin], np.arange(s.rows + 1))]) + specials


_MACHINES: dict[str, TokenMachine] = {}


def machine_of(path: str) -> TokenMachine:
    """The worker's own machine; its table lives as long as the worker does."""
    if path not in _MACHINES:
        _MACHINES[path] = TokenMachine(path)
    return _MACHINES[path]


OUT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a text: its UTF-8 bytes, its tokens and whether they are more than ``limit``."""
    ship(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    packed = code_point_symbols(path)
    names = [x.split()[0] for x in OUT.split(", ")]

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(path)
        kinds = np.frombuffer(zlib.decompress(packed), np.uint8)
        for b in it:
            for s in slices(b.column(1)):
                n = count_tokens(s, machine, kinds)
                yield pa.record_batch([b.column(0).slice(s.lo, s.rows), pa.array(np.diff(s.off)), pa.array(n), pa.array(n > limit)], names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(count, OUT)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
