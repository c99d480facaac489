"""Byte-level BPE over whole texts, a distinct unit at a time.

A byte-level BPE splits a text by a pattern first, and each match is merged by itself. At many places a match
begins whatever else the text holds, as between a letter and a full stop or before a space and a letter (see _TABLE),
so a text falls apart there into units whose ids do not depend on their surroundings. Units recur: a run of texts is
split, its units are numbered and looked up by Arrow's hash kernels, only new ones meet the tokenizer's library, and
the ids of all texts are gathered from the units' by numpy. Texts with a special string inside go to the library whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loomdoc.llm.common import trim

#: Kinds of bytes: others (all that is not sure), letters, digits, ASCII punctuation and symbols, the apostrophe, the space, tabs
#: and line ends. Both bytes of the letters from U+00C0 to U+00FF are letters, which units_of() adds.
_OTHER, _LETTER, _DIGIT, _MARK, _QUOTE, _SPACE, _LINE = range(7)
_KINDS = bytes(_LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _QUOTE if b == 39 else _SPACE if b == 32 else _LINE if b in b"\t\n\r" else _MARK if 33 <= b < 127 else _OTHER for b in range(128)) + bytes(128)
_BLANK, _FULL = (_SPACE, _LINE), (_LETTER, _DIGIT, _MARK, _QUOTE)


def _rule(a: int, b: int) -> int:
    """Of bytes of kinds a and b in a row: 1 if a match begins with b, plus 2 if one begins with a.

    A run of letters or of digits ends where it ends, and so does one of marks, though an apostrophe may take letters with
    it. White space after anything else begins a match; of several, the last before something else begins one, and
    only a space becomes part of what follows it. Without its surroundings no part is matched otherwise: the pattern looks
    ahead after white space alone, and whether white space or the end follows is one to it.
    """
    with_b = a in (_LETTER, _DIGIT) and b in _FULL and a != b or a == _MARK and b in (_LETTER, _DIGIT) or a in _FULL and b in _BLANK or a == _LINE and b in _FULL
    return with_b + 2 * (a in _BLANK and b in _FULL)


_TABLE = bytes(_rule(i >> 3, i & 7) for i in range(64)) + bytes(192)
#: Units before which a match begins as they are, and those for which one does after a line end.
_AFTER_ALL, _AFTER_LINE = re.compile(r" [!-~\u00c0-\u024f]").match, re.compile(r"[!-~\u00c0-\u024f]").match
#: Characters of text in a run, and in a part of a longer text.
RUN_CHARS = 4_000_000
#: Characters that the library gets in a call, unless one text has more; it takes some 200 bytes for each until the call ends.
CALL_CHARS = 30_000
#: Units whose ids are gathered at once.
GATHER = 1 << 16
#: Units that a worker remembers at most, about 30 bytes each.
MAX_UNITS = 300_000


def split_long(text: str, run: int) -> Iterator[str]:
    """The text in order, in parts that begin where a unit begins."""
    at = 0
    while len(text) - at > run:
        cut = text.find(" ", at + run)
        while 0 <= cut < len(text) - 1 and text[cut + 1].isspace():
            cut = text.find(" ", cut + 1)
        if cut < 0 or cut == len(text) - 1:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def units_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts in one array, and how many each text has; together they are the texts."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[: len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: bounds[-1]]
    if not len(data):
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    kinds = np.frombuffer(bytearray(data.tobytes().translate(_KINDS)), np.uint8)
    pairs = np.flatnonzero(data[:-1] == 0xC3)
    pairs = pairs[data[pairs + 1] & 0xDF != 0x97]  # not the signs of multiplication and division
    kinds[pairs] = kinds[pairs + 1] = _LETTER
    rule = np.frombuffer((kinds[:-1] << 3 | kinds[1:]).tobytes().translate(_TABLE), np.uint8)
    own = rule > 1
    full = bounds[:-1] < bounds[1:]
    starts = bounds[:-1][full]
    own[starts[1:] - 1] = False  # what follows is another text
    begins = np.zeros(len(data), bool)
    begins[:-1] = own
    begins[1:] |= rule & 1 != 0
    begins[starts] = True
    at = np.flatnonzero(begins).astype(np.int32)
    counts = np.zeros(len(texts), np.int64)
    counts[full] = np.diff(np.append(np.searchsorted(at, starts), len(at)))
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(np.append(at, bounds[-1])), texts.buffers()[2]), counts


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i], ..., starts[i] + lengths[i] - 1 for every i in turn."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 1 << 30 and (not len(starts) or starts.max() < 1 << 30) else np.int64
    out = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


class Units:
    """Ids of texts from the ids of their units.

    encode: ids (one flat array) and numbers of ids of a list of texts, each by itself. special: strings that the
    library takes out of a text before it splits it. run, most: characters of a run and units remembered, where they
    are not to be RUN_CHARS and MAX_UNITS; more of both take memory and spare calls of the library.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], special: tuple[str, ...] = (), run: int = 0, most: int = 0):
        self.encode = encode
        self.run, self.most = run, most
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.runs = 0
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.ids, self.starts, self.lengths = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _unsafe(self, text: str) -> bool:
        return bool(self.special and self.special.search(text))

    def _run(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers of ids of texts without special strings."""
        parts, own = units_of(pa.array(texts, pa.string()))
        coded = parts.dictionary_encode()
        del parts  # a run's arrays go as soon as they are used, or they add up to many times its text
        units, index = coded.dictionary, coded.indices.to_numpy()
        at = pc.index_in(units, self.known)
        where = at.fill_null(-1).to_numpy().astype(np.int32)
        del at
        missing = np.flatnonzero(where < 0)
        new = units.take(pa.array(missing))
        ids, lengths = self.encode(new.to_pylist())
        starts = np.cumsum(lengths) - lengths
        n = len(missing)
        base_starts, base_lengths, base_ids = self.starts, self.lengths, self.ids
        if n > 0.9 * len(units) and len(self.known) > 0.9 * (self.most or MAX_UNITS):
            self.forget()  # the texts have changed
        all_ids = np.concatenate([base_ids, ids])
        all_starts = np.concatenate([base_starts, starts + len(base_ids)])
        all_lengths = np.concatenate([base_lengths, lengths])
        where[missing] = len(base_starts) + np.arange(n)
        index = where[index]
        del coded, where
        counts, some = np.zeros(len(texts), np.int64), own > 0
        if some.any():
            counts[some] = np.add.reduceat(all_lengths.astype(np.int32)[index], (np.cumsum(own) - own)[some], dtype=np.int64)
        out, done = np.empty(int(counts.sum()), "<u4"), 0
        for at in range(0, len(index), GATHER):
            some = index[at : at + GATHER]
            got = all_ids[spread(all_starts[some], all_lengths[some])]
            out[done : done + len(got)] = got
            done += len(got)
        del index
        if len(self.known) + n <= (self.most or MAX_UNITS) and n:
            self.known = pa.concat_arrays([self.known, new])
            self.starts = np.concatenate([self.starts, starts + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
            self.lengths = np.concatenate([self.lengths, lengths])
        return out, counts

    def __call__(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Runs of texts in order: the first one's index, the ids of all in one array, the number of ids of each."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= (self.run or RUN_CHARS)):
                size += len(texts[end])
                end += 1
            yield at, *self._some(texts[at:end])
            self.runs += 1
            if self.runs % 2 == 0:
                trim()
            at = end

    def _some(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = [i for i, t in enumerate(texts) if self._unsafe(t)]
        parts: list[str] = []
        owner: list[int] = []
        skip = set(odd)
        for i, t in enumerate(texts):
            if i not in skip:
                for part in split_long(t, self.run or RUN_CHARS):
                    parts.append(part)
                    owner.append(i)
        if len(parts) > len(texts):  # a long text's parts, one by one
            runs = [self._run([p]) for p in parts]
            ids, sizes = np.concatenate([r[0] for r in runs]), np.concatenate([r[1] for r in runs])
        elif parts:
            ids, sizes = self._run(parts)
        else:
            ids, sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64)
        counts = np.bincount(np.array(owner, np.int64), weights=sizes, minlength=len(texts)).astype(np.int64)
        if not odd:
            return ids, counts
        more, lengths = self.encode([texts[i] for i in odd])
        starts = np.cumsum(counts) - counts
        counts[odd] = lengths
        starts[odd] = len(ids) + np.cumsum(lengths) - lengths
        return np.concatenate([ids, more])[spread(starts, counts)], counts


def json_units(path: str, run: int = 0, most: int = 0) -> Units:
    """Ids as the tokenizers library gives them for a byte-level BPE file, special strings inside texts included."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    special = {t.content: i for i, t in tok.get_added_tokens_decoder().items()}
    fence = next(iter(special), None)
    state = json.loads(tok.pre_tokenizer.__getstate__()) if tok.pre_tokenizer else {}
    plain = tok.normalizer is None and state.get("type") == "ByteLevel" and state.get("use_regex") and not state.get("add_prefix_space")
    vocab = tok.get_vocab(with_added_tokens=False)
    size_of = np.zeros(max([*vocab.values(), *special.values()], default=0) + 1, np.int64)
    size_of[list(vocab.values())] = list(map(len, vocab))  # a character stands for a byte
    size_of[list(special.values())] = [len(x.encode()) for x in special]

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Texts by calls of moderate size."""
        parts, at = [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < CALL_CHARS:
                size += len(texts[end])
                end += 1
            parts.append(call(texts[at:end]))
            at = end
        return tuple(np.concatenate([none, *x]) for none, x in zip((np.zeros(0, "<u4"), np.zeros(0, np.int64)), zip(*parts, strict=True) if parts else ((), ()), strict=True))

    def call(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All in one call, one after another: as they are, after a line end, or between special strings, which the library takes out first."""
        if plain and fence is not None and not any(fence in t for t in texts):
            joins = [("", "") if _AFTER_ALL(t) else ("\n", "") if _AFTER_LINE(t) else (fence, fence) for t in texts]
            ids = np.array(tok.encode_batch_fast(["".join([x for (a, b), t in zip(joins, texts, strict=True) for x in (a, t, b)])], add_special_tokens=False)[0].ids, "<u4")
            sizes = np.array([(len(a), len(t.encode()), len(b)) for (a, b), t in zip(joins, texts, strict=True)], np.int64)
            ends = np.cumsum(sizes).reshape(-1, 3)
            at = np.concatenate([[0], np.cumsum(size_of[ids])])  # bytes before each id
            first, last = np.searchsorted(at, ends[:, 0]), np.searchsorted(at, ends[:, 1])
            if at[-1] == ends[-1, 2] and (at[first] == ends[:, 0]).all() and (at[last] == ends[:, 1]).all():
                return ids[spread(first, last - first)], last - first
        each = [np.array(e.ids, "<u4") for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, "<u4"), *each]), np.array([len(x) for x in each], np.int64)

    return Units(encode, tuple(special) if plain else ("",), run, most)  # by another pattern texts don't fall apart


_loaded: dict = {}


def loaded(kind: str, path: str, make: Callable):
    """One of each kind and path in a worker; Spark keeps workers between tasks."""
    if (kind, path) not in _loaded:
        _loaded[kind, path] = make(path)
    return _loaded[kind, path]


def encoder(path: str, run: int = 0, most: int = 0) -> Units:
    return loaded(f"json {run} {most}", path, lambda p: json_units(p, run, most))
