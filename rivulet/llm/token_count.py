"""Op 8: token counts by a tokenizer compiled to a deterministic finite-state transducer.

The tokenizer is a BPE vocabulary with a word-end mark, over lower-case words that a pattern cuts. Its BPE part is a
transducer over bytes. A tokenization is right exactly if each neighbouring pair of tokens is what BPE makes of the
two together, so the last token of every prefix of a word follows from the last tokens of shorter prefixes that a
vocabulary entry can still reach back to. A state is therefore the longest suffix that begins a vocabulary entry,
with the last token and relative token count at each place in it that one may reach back to: finitely many. A
transition carries the change in the number of tokens emitted so far (it may be negative where a merge takes tokens
back); a last byte carries the change to the word's final count. States are compiled when first met and kept in
dense tables of bounded size, which start anew when full.

A batch's texts are one stream of bytes, cut into chunks of equal length that all step at once through the tables.
A chunk's state map is constant from its first word start on, whatever state it is entered with; the exit states
then enter the chunks behind them, in a scan, and only a word longer than a chunk needs more than one round of it.
The sums of emitted counts between text borders are the results.

Defined results. Null text: empty, 0 tokens. Strings of special tokens inside a text count as one token each, as is
the library's default. Whole texts of any length are read. Extra columns pass through.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import freeing, small_batches, table

END = "</w>"
# Unicode White_Space, and the pattern's contractions.
SPACE_POINTS = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
BLANK, LETTER, NUMBER, OTHER = range(4)
CHUNK = 64
#: Entries of the transition tables, 8 bytes each.
MAX_ENTRIES = 16 << 20
MISSING, HARD = -1, -2


def _classes() -> np.ndarray:
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    out[SPACE_POINTS] = BLANK
    return out


class Transducer:
    """Lazily compiled; ``step`` tables are indexed by state * columns + column of the byte."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if model["end_of_word_suffix"] != END or kinds != ["NFC", "Replace", "Lowercase"] or pattern != WORD_PATTERN:
            raise ValueError(f"not a lower-case word BPE file: {path}")
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, self.specials)))
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.symbol = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        back = {s: b for b, s in self.symbol.items()}
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.mid: dict[bytes, str] = {}  # by bytes: tokens inside a word, tokens that end one
        self.last: dict[bytes, str] = {}
        self.prefix: set[bytes] = {b""}
        for t in model["vocab"]:
            ends = t.endswith(END) and t != END
            raw = t[: -len(END)] if ends else t
            if t in self.specials or any(c not in back for c in raw):
                continue
            b = bytes(back[c] for c in raw)
            (self.last if ends else self.mid)[b] = t
            self.prefix.update(b[:i] for i in range(1, len(b)))
        self.pair: dict[tuple[str | None, str], bool] = {}
        self.classes = _classes()
        self._reset()

    # -- the BPE rule itself ------------------------------------------------------------------------------------

    def parts(self, token: str) -> list[str]:
        return [*token[: -len(END) - 1], token[-len(END) - 1 :]] if token.endswith(END) else list(token)

    def bpe(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            best = min(range(len(symbols) - 1), key=lambda i: self.rank.get((symbols[i], symbols[i + 1]), 1 << 60))
            pair = (symbols[best], symbols[best + 1])
            if pair not in self.rank:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == pair:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def count(self, word: bytes) -> int:
        """Tokens of one word by the BPE rule, for transitions that are not decided by pairs."""
        s = [self.symbol[b] for b in word]
        s[-1] += END
        return len(self.bpe(s))

    def fits(self, before: str | None, token: str) -> bool:
        key = (before, token)
        ok = self.pair.get(key)
        if ok is None:
            if len(self.pair) > 500_000:
                self.pair.clear()
            want = [token] if before is None else [before, token]
            ok = self.pair[key] = self.bpe([s for t in want for s in self.parts(t)]) == want
        return ok

    # -- compilation --------------------------------------------------------------------------------------------

    def _reset(self) -> None:
        self.columns, self.rows = 64, 1 << 10
        self.column = np.full(256, -1, np.int32)
        self.bytes_: list[int] = []
        start = (b"", ((0, None, 0),))  # suffix; (bytes from the end, last token, count relative to here)
        self.ids, self.states = {start: 0}, [start]
        self._tables()

    def _tables(self) -> None:
        old = getattr(self, "next", None) is not None and len(self.states) > 1
        nxt = np.full((self.rows, self.columns), MISSING, np.int32)
        emit = np.zeros((self.rows, self.columns), np.int16)
        final = np.full((self.rows, self.columns), -(1 << 15), np.int16)
        if old:
            r, c = self.shape
            a, b = min(r, self.rows), min(c, self.columns)
            for new, was in ((nxt, self.next), (emit, self.emit), (final, self.final)):
                new[:a, :b] = was.reshape(r, c)[:a, :b]
        self.next, self.emit, self.final, self.shape = nxt.ravel(), emit.ravel(), final.ravel(), (self.rows, self.columns)

    def _options(self, state, byte: int, ends: bool):
        suffix, places = state
        x = bytes([byte])
        vocab = self.last if ends else self.mid
        out = []
        for back, before, rel in places:
            token = vocab.get((suffix[len(suffix) - back :] if back else b"") + x)
            if token is not None and self.fits(before, token):
                out.append((token, rel + 1))
        return out

    def compile(self, state_id: int, byte: int, ends: bool) -> None:
        at = state_id * self.columns + self.column[byte]
        state = self.states[state_id]
        found = self._options(state, byte, ends)
        if ends:
            self.final[at] = found[0][1] if len(found) == 1 else -(1 << 15) + 1
            return
        if len(found) != 1:
            self.next[at] = HARD
            return
        token, delta = found[0]
        text = state[0] + bytes([byte])
        keep = next(i for i in range(len(text) + 1) if text[i:] in self.prefix)
        suffix = text[keep:]
        places = tuple((b + 1, t, r - delta) for b, t, r in state[1] if b + 1 <= len(suffix) and text[len(text) - b - 1 :] in self.prefix)
        key = (suffix, (*places, (0, token, 0)))
        new = self.ids.get(key)
        if new is None:
            new = self.ids[key] = len(self.states)
            self.states.append(key)
            if new >= self.rows:
                self.rows *= 2
                self._tables()
                at = state_id * self.columns + self.column[byte]
        self.next[at], self.emit[at] = new, delta

    def _learn(self, state: np.ndarray, byte: np.ndarray, ends: bool) -> None:
        pairs = np.unique(state.astype(np.int64) << 8 | byte)
        for p in pairs.tolist():
            self.compile(p >> 8, p & 255, ends)

    def _columns_for(self, data: np.ndarray) -> None:
        for b in np.flatnonzero(np.bincount(data, minlength=256)).tolist():
            if self.column[b] < 0:
                if len(self.bytes_) == self.columns:
                    self.columns *= 2
                    self._tables()
                self.column[b] = len(self.bytes_)
                self.bytes_.append(b)

    # -- running ------------------------------------------------------------------------------------------------

    def _advance(self, state, data, begin, end, live):
        """One byte for each lane: (state, emitted, undecided)."""
        state = np.where(begin, 0, state)
        at = state * self.columns + self.column[data]
        nxt, fin = self.next[at], self.final[at]
        need = live & ~end & (nxt == MISSING)
        need_end = live & end & (fin == -(1 << 15))
        if need.any() or need_end.any():
            if need.any():
                self._learn(state[need], data[need], False)
            if need_end.any():
                self._learn(state[need_end], data[need_end], True)
            at = state * self.columns + self.column[data]
            nxt, fin = self.next[at], self.final[at]
        out = np.where(end, fin, self.emit[at])
        bad = live & ((end & (fin == -(1 << 15) + 1)) | (~end & (nxt == HARD)) | (state == HARD))
        return np.where(nxt < 0, 0, nxt), np.where(live, out, 0), bad

    def weights(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens emitted at each byte of a stream of words, marked by their first and last bytes."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int32)
        if len(self.states) * self.columns > MAX_ENTRIES:
            self._reset()
        self._columns_for(data)
        lanes = -(-n // CHUNK)
        pad = lanes * CHUNK - n
        step = lambda x, fill: np.ascontiguousarray(np.concatenate([x, np.full(pad, fill, x.dtype)]).reshape(lanes, CHUNK).T)
        d, b, e, real = step(data, data[0]), step(begin, False), step(end, False), step(np.ones(n, bool), False)
        out = np.zeros((CHUNK, lanes), np.int32)
        bad = np.zeros((CHUNK, lanes), bool)
        seen = np.zeros(lanes, bool)  # a word start lies behind: the map is constant from there
        before = np.zeros((CHUNK, lanes), bool)  # bytes ahead of the first word start
        state = np.zeros(lanes, np.int64)
        for j in range(CHUNK):
            seen |= b[j]
            before[j] = ~seen & real[j]
            state, out[j], bad[j] = self._advance(state, d[j], b[j], e[j], seen & real[j])
        known, exits = seen.copy(), state
        todo = np.flatnonzero(before[0])
        while len(todo):  # the scan: chunks behind a known exit; one round unless words outlast a chunk
            go = todo[known[todo - 1]]
            s = exits[go - 1]
            for j in range(CHUNK):
                live = before[j, go]
                if not live.any():
                    break
                t, o, w = self._advance(s, d[j, go], np.zeros(len(go), bool), e[j, go], live)
                s = np.where(live, t, s)
                out[j, go] += np.where(live, o, 0)
                bad[j, go] |= w
            through = ~seen[go]
            exits[go[through]] = s[through]
            known[go] = True
            todo = np.setdiff1d(todo, go, assume_unique=True)
        flat, wrong = out.T.ravel()[:n], bad.T.ravel()[:n]
        if wrong.any():  # not decided by pairs: these words by the rule itself
            starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
            for w in np.unique(np.searchsorted(starts, np.flatnonzero(wrong), "right") - 1).tolist():
                flat[starts[w] : ends[w]] = 0
                flat[ends[w] - 1] = self.count(data[starts[w] : ends[w]].tobytes())
        return flat

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of the words, first-byte marks, last-byte marks, how many such bytes each character adds)."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kind = self.classes[points]
        n = len(points)
        begin = np.ones(n, bool)
        begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        quote = np.flatnonzero((points[:-1] == 39) & begin[:-1] & (kind[1:] == LETTER)) if n > 1 else []
        if len(quote):  # a contraction: the apostrophe alone in its run, right before letters
            padded = np.concatenate([points, np.zeros(2, np.uint32)])
            one, two = padded[quote + 1], padded[quote + 2]
            done = np.zeros(len(quote), bool)
            for c in CONTRACTIONS:
                hit = ~done & (one == ord(c[0]))
                if len(c) == 2:
                    hit &= two == ord(c[1])
                done |= hit
                at = quote[hit]
                begin[at + 1] = False
                cut = at + 1 + len(c)
                cut = cut[cut < n]
                begin[cut] = True
        size = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        data = np.frombuffer(text.encode(), np.uint8)
        solid = kind != BLANK
        first = np.cumsum(size) - size
        b = np.zeros(len(data), bool)
        b[first[begin & solid]] = True
        e = np.zeros(len(data), bool)
        stop = np.ones(n, bool)
        stop[:-1] = begin[1:]
        e[(first + size - 1)[stop & solid]] = True
        keep = np.repeat(solid, size)
        return data[keep], b[keep], e[keep], size * solid

    def counts(self, texts: list[str], limit: int = 1 << 20) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        held, owners, total = [], [], 0

        def flush():
            nonlocal total
            if held:
                # a line break between texts ends words there and belongs to none
                np.add.at(out, owners, self._run(held))
            held.clear()
            owners.clear()
            total = 0

        for i, text in enumerate(texts):
            segments = [text]
            if "<|" in text and (found := self.special.findall(text)):
                out[i] += len(found)
                segments = self.special.split(text)
            for s in segments:
                s = s if unicodedata.is_normalized("NFC", s) else unicodedata.normalize("NFC", s)
                s = s.replace("Σ", "σ").lower()
                if s:
                    held.append(s)
                    owners.append(i)
                    total += len(s)
            if total >= limit:
                flush()
        flush()
        return out

    def _run(self, segments: list[str]) -> np.ndarray:
        data, begin, end, adds = self.words("\n".join(segments))
        w = np.concatenate([[0], np.cumsum(self.weights(data, begin, end))])
        chars = np.cumsum([len(x) + 1 for x in segments])  # each with the line break behind it
        at = np.concatenate([[0], np.cumsum(adds), [adds.sum()]])
        return np.diff(w[at[np.concatenate([[0], chars])]])


_TRANSDUCERS: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One per worker process and file."""
    if path not in _TRANSDUCERS:
        _TRANSDUCERS[path] = Transducer(path)
    return _TRANSDUCERS[path]


def token_counts(docs: DataFrame, tokenizer: str, *, text: str = "text", limit: int = 2048) -> DataFrame:
    """``docs`` with ``n_bytes, n_tokens, over_limit``; columns of these names are replaced."""
    docs = docs.drop("n_bytes", "n_tokens", "over_limit")
    small_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def count(batches):
        t = transducer(tokenizer)
        for batch in batches:
            texts = [x or "" for x in batch.column(at).to_pylist()]
            n = t.counts(texts)
            size = pa.array([len(x.encode()) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, size, pa.array(n), pa.array(n > limit)], [*batch.schema.names, "n_bytes", "n_tokens", "over_limit"])

    fields = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(freeing(count), f"{fields}, n_bytes long, n_tokens long, over_limit boolean")


def op8_token_count(spark, sf_dir: str) -> DataFrame:
    """Query: the token count of every document."""
    import public_tokenizers

    out = token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")
