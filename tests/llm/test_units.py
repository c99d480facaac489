"""Texts fall apart into units wherever a match surely begins, so that few distinct ones meet the library."""

import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loomdoc.llm import bytebpe, spm_bpe, token_counts

JSON = public_tokenizers.path("byte_bpe_50k.json")
WORDS = [f"{a}{b}" for a in ("Mot", "zeß", "élan", "naïf", "sur", "à") for b in ("on", "eur", "é", "ique", "Ä")]
#: Characters and pairs around which matches begin, or don't.
PIECES = [*"aZébß×÷ÀÿñĀ019\n\n\t\r\x0b\x1c\x1f\x00\x7f''.,-_(\"«\xa0\x85　½٣字́​😀     ", "'s", "'ll", " '", "  ", "\n ", "ab", "12"]


def encoded(units, texts):
    return [x.tolist() for _, ids, n in units(texts) for x in np.split(ids, np.cumsum(n)[:-1])]


def test_words_before_marks_and_line_ends_are_units_of_their_own():
    rng = random.Random(2)
    texts = ["".join(rng.choice(WORDS) + rng.choice([" ", ". ", ", ", "\n", ".\n", "-", "17 ", " (", ") "]) for _ in range(400)) for _ in range(20)]
    units = bytebpe.json_units(JSON)
    asked, whole = [], units.encode
    units.encode = lambda t: asked.extend(t) or whole(t)
    tok = Tokenizer.from_file(JSON)
    assert encoded(units, texts) == [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    assert len(asked) == len(set(asked)) <= 2 * len(WORDS) + 20  # with a space before them and without


def test_units_are_the_texts_and_ids_those_of_whole_texts():
    rng = random.Random(3)
    tok, ranks = Tokenizer.from_file(JSON), spm_bpe.RankCoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    counts, units = token_counts.PrefixCounts(JSON), bytebpe.json_units(JSON, run=200, most=100)
    texts = ["".join(rng.choices(PIECES, k=rng.choice([0, 1, 2, 3, 4, 6, 20]))) for _ in range(4000)] + [" ".join(rng.choices(PIECES, k=300)), "", ""]
    parts, n = bytebpe.units_of(bytebpe.pa.array(texts))
    ends = np.cumsum(n).tolist()
    assert ["".join(parts[e - k : e].to_pylist()) for e, k in zip(ends, n.tolist(), strict=True)] == texts
    want = [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    assert encoded(units, texts) == want
    assert list(counts.totals(texts)) == list(map(len, want))
    ids, n = ranks._encode(texts)
    assert encoded(ranks.units, texts) == [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


@pytest.mark.parametrize("change", [{"use_regex": False}, {"add_prefix_space": True}])
def test_a_file_with_another_pattern_gets_whole_texts(tmp_path, change):
    with open(JSON) as f:
        made = json.load(f)
    made["pre_tokenizer"] |= change
    (tmp_path / "t.json").write_text(json.dumps(made))
    texts = ["one two.three\nfour  5x", " a", "", "Mot. zwei"]
    units = bytebpe.json_units(str(tmp_path / "t.json"))
    asked, whole = [], units.encode
    units.encode = lambda t: asked.extend(t) or whole(t)
    assert encoded(units, texts) == [e.ids for e in Tokenizer.from_file(str(tmp_path / "t.json")).encode_batch_fast(texts, add_special_tokens=False)]
    assert asked == texts
