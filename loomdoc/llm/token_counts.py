"""Token counts at every prefix of a text, by dynamic programming over the byte-level BPE's vocabulary.

The last token of a prefix is the longest vocabulary entry that ends it and that can stand after the last token of
what is left; counts follow from the shorter prefix. An automaton over the vocabulary names the entries that end at each
byte, longest first, so the cost of a match is linear in its bytes. That gives the exact count of every prefix of a match, and with
the matches' running sum that of every prefix of a text, so truncation and budget questions need no second encoding.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loomdoc.llm.bytebpe import Units, loaded
from loomdoc.llm.common import slices

MAX_WORDS, MAX_PAIRS = 400_000, 1_000_000


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class PrefixCounts:
    """Counts for every prefix of a text under a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        import public_tokenizers

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        back = {c: b for b, c in enumerate(byte_chars())}
        as_bytes = lambda s: bytes(back[c] for c in s)
        pairs = (m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"])
        self.rank = {}
        for i, (a, b) in enumerate(pairs):
            self.rank[as_bytes(a), as_bytes(b)] = i
        self.vocab = {as_bytes(t): i for t, i in model["vocab"].items()}
        self.ends = ahocorasick.Automaton()
        for t in self.vocab:
            self.ends.add_word(t.decode("latin-1"), t)
        self.ends.make_automaton()
        self.tok = Tokenizer.from_file(path)
        pattern = regex.compile(public_tokenizers.PATTERN)
        self.find, self.matches = pattern.findall, pattern.finditer
        self.special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        self.special_re = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.words: dict[str, np.ndarray] = {}
        self.units = Units(self._encode, tuple(self.special))

    def _merge(self, word: bytes) -> list[bytes]:
        parts = [word[i : i + 1] for i in range(len(word))]
        rank = self.rank
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _fits(self, a: bytes, b: bytes) -> bool:
        """Whether a and b side by side stay as they are."""
        if (a, b) not in self.fits:
            if len(self.fits) > MAX_PAIRS:
                self.fits.clear()
            self.fits[a, b] = self._merge(a + b) == [a, b]
        return self.fits[a, b]

    def byte_counts(self, word: bytes) -> list[int]:
        """Tokens of each prefix of a match, by bytes, from the empty one on."""
        count, last = [0], [b""]
        known, done = self.fits, 0
        for at, t in self.ends.iter(word.decode("latin-1")):  # by ends, for each the longest first
            if at < done:
                continue
            start = at + 1 - len(t)
            before = last[start]
            if not start or (known[before, t] if (before, t) in known else self._fits(before, t)):
                count.append(count[start] + 1)
                last.append(t)
                done = at + 1
        return count

    def _word(self, word: str) -> np.ndarray:
        """Tokens of each prefix of a match, by characters."""
        if word not in self.words:
            if len(self.words) > MAX_WORDS:
                self.words.clear()
            data = word.encode()
            counts = self.byte_counts(data)
            if len(data) != len(word):
                counts = [counts[i] for i in range(len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]
            if word[0] == "'" and len(word) == 3 and word[1:].isalpha():  # 'll, 're, 've: the pattern knows no "'l"
                counts[2] = 1 + self.byte_counts(word[1:2].encode())[-1]
            self.words[word] = np.array(counts, np.int32)
        return self.words[word]

    def _split(self, text: str) -> list[str]:
        """The library's matches; an added token's string is one of them."""
        out, at = [], 0
        for m in self.special_re.finditer(text) if self.special_re else ():
            out += [*self._plain(text[at : m.start()]), m[0]]
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        if not text.isascii() and any(map(_unassigned, set(text))):  # Unicode versions differ on these
            return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]
        return self.find(text)

    def _each(self, text: str) -> Iterator[str]:
        """As _split, one match after another where that is possible."""
        if self.special_re and self.special_re.search(text) or not text.isascii() and any(map(_unassigned, set(text))):
            yield from self._split(text)
        else:
            for m in self.matches(text):
                yield m[0]

    def _total(self, match: str) -> int:
        return 1 if match in self.special else int(self._word(match)[-1])

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One number a text: its tokens."""
        split = self._split
        counts = np.array([sum(map(self._total, split(t))) for t in texts], "<u4")
        return counts, np.ones(len(texts), np.int64)

    def totals(self, texts: list[str]) -> Iterator[int]:
        """Tokens of each text."""
        for _, counts, sizes in self.units(texts):
            ends = np.cumsum(sizes)
            sums = np.concatenate([[0], np.cumsum(counts.astype(np.int64))])
            yield from (sums[ends] - sums[ends - sizes]).tolist()

    def _places(self, text: str) -> Iterator[tuple]:
        """For each match: itself, its start, the tokens before it, the spaces before it (start and tokens before them,
        none if no spaces are), and where the run of ordinary text around it began, with the tokens before that."""
        at, total, gap = 0, 0, None
        since, before = 0, 0
        for match in self._each(text):
            yield match, at, total, gap, since, before
            special = match in self.special
            n = 1 if special else self._total(match)
            gap = (at, total) if not special and match.isspace() else None
            at, total = at + len(match), total + n
            if special:
                since, before = at, total

    def _inside(self, text: str, place: tuple) -> np.ndarray:
        """Tokens of the prefixes that end in a match, from its first character to its last."""
        match, at, total, gap, since, before = place
        if match in self.special:
            return np.array([before + sum(map(self._total, self._plain(text[since : at + i]))) for i in range(1, len(match))] + [total + 1])
        inner = total + self._word(match)[1:].astype(np.int64)
        if gap is not None and match[0].isspace():  # up to here, the spaces before belong to one match
            inner[0] = gap[1] + int(self._word(text[gap[0] : at + 1])[-1])
        return inner

    def prefixes(self, text: str) -> np.ndarray:
        """Tokens of text[:i] for every i from 0 to its length.

        A prefix is taken as a text of its own: spaces that end it are one match, and part of a special string is
        ordinary text.
        """
        return np.concatenate([np.zeros(1, np.int64), *(self._inside(text, p) for p in self._places(text))])

    def cut(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most budget tokens."""
        seen = []
        for p in self._places(text):
            if p[2] > budget and p[3] is None:
                break  # longer prefixes hold the matches before this one whole
            seen.append(p)
        for p in reversed(seen):
            fit = np.flatnonzero(self._inside(text, p) <= budget)
            if len(fit):
                return p[1] + int(fit[-1]) + 1
        return 0


def _unassigned(c: str) -> bool:
    return unicodedata.category(c) == "Cn"


def token_counts(docs: DataFrame, path: str, budget: int = 512, prefixes: bool = False, cuts: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every text, whether they are over a budget, and on demand the counts of all prefixes.

    Null texts count as empty ones; every row gives a row, repeated and null ids too; other columns are left out.
    cuts adds cut_chars, the length of the longest prefix within the budget; prefixes adds prefix_tokens, the count
    for every prefix. No shuffle; a worker holds a run of texts at a time. Very long texts, unbroken ones too, cost in
    proportion to their length.
    """
    fields = [pa.field("doc_id", pa.int64()), pa.field("n_bytes", pa.int64()), pa.field("n_tokens", pa.int64()), pa.field("over_limit", pa.bool_())]
    ddl = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    if cuts:
        fields.append(pa.field("cut_chars", pa.int64()))
        ddl += ", cut_chars long"
    if prefixes:
        fields.append(pa.field("prefix_tokens", pa.list_(pa.int32())))
        ddl += ", prefix_tokens array<int>"
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded("prefix", path, PrefixCounts)
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            n = np.fromiter(counter.totals(texts), np.int64, len(texts))
            cols = [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n), pa.array(n > budget)]
            if cuts:
                cols.append(pa.array([counter.cut(t, budget) if k > budget else len(t) for t, k in zip(texts, n, strict=True)], pa.int64()))
            if prefixes:
                cols.append(pa.array([counter.prefixes(t).tolist() for t in texts], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"coalesce(cast(`{text_col}` as string), '') as text").mapInArrow(run, ddl)
